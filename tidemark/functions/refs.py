"""Column expressions over node references and qualified names."""

from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def ref_to_uuid(ref):
    """Part after the store of a `protocol://store/uuid` reference; null when the whole text does not match."""
    # Fixed value: the shape of a reference.
    return F.get(F.regexp_extract_all(_col(ref), F.lit(r"^.+://.+/(.+)\z"), F.lit(1)), F.lit(0))


def has_tail(ref):
    return F.instr(_col(ref), "/") > 0


def ref_tail(ref, on_error="fail"):
    """Text after the last slash. A reference without a slash raises, or is null with on_error="null"."""
    ref = _col(ref)
    tail = F.substring_index(ref, "/", -1)
    if on_error == "null":
        return F.when(has_tail(ref), tail)
    failure = F.raise_error(F.concat(F.lit("reference without a slash: "), ref)).cast("string")
    return F.when(ref.isNull() | has_tail(ref), tail).otherwise(failure)


def qname_uri(name):
    """`{uri}` of `{uri}local`, up to and including the last brace; empty when there is none."""
    name = _col(name)
    return F.substr(name, F.lit(1), F.length(name) - F.length(qname_local(name)))


def qname_local(name):
    """Text after the last brace of `{uri}local`."""
    return F.substring_index(_col(name), "}", -1)


def model_prefix(name):
    """Text before the first colon of a model name; null when there is no colon."""
    name = _col(name)
    return F.when(F.instr(name, ":") > 0, F.substring_index(name, ":", 1))
