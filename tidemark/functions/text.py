"""Text escaping for JSON payloads and its clean-up counterpart."""

from pyspark.sql import functions as F

ASCII_JSON = {"writeNonAsciiCharacterAsCodePoint": "true"}

# One or more \uXXXX units that make whole characters: a surrogate pair, or any unit that is no surrogate.
# A lone surrogate is no character a UTF-8 string can hold, so its escape stays as it is.
_UNIT = r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u(?![dD][89a-fA-F])[0-9A-Fa-f]{4}"
_RUN = f"(?:{_UNIT})++"


def escape_json(text):
    """Body of an ASCII-only JSON string literal holding the text; null for null."""
    whole = F.to_json(F.array(text), ASCII_JSON)
    return F.when(text.isNotNull(), F.substr(whole, F.lit(3), F.length(whole) - 4))


def unescape_unicode(text):
    """Replace every \\uXXXX escape by its character; other escapes are left alone."""
    runs = F.regexp_extract_all(text, F.lit(_RUN), F.lit(0))
    decoded = F.transform(
        runs, lambda r: F.decode(F.unhex(F.replace(r, F.lit("\\u"), F.lit(""))), "UTF-16BE")
    )
    pieces = F.zip_with(
        F.split(text, _RUN, -1),
        decoded,
        lambda plain, run: F.concat(plain, F.coalesce(run, F.lit(""))),
    )
    return F.when(F.instr(text, "\\u") > 0, F.array_join(pieces, "")).otherwise(text)
