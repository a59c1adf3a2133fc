"""Field-name codec of the index."""

from pyspark.sql import functions as F


def encode_name(name):
    """URL-encode a property name, also escaping the marks a search engine reserves."""
    encoded = F.url_encode(name)
    # Marks left alone by URL encoding and what they become.
    for mark, escape in ((".", "%2E"), ("-", "%2D"), ("*", "%2A"), ("+", "%20")):
        encoded = F.replace(encoded, F.lit(mark), F.lit(escape))
    return encoded


def decode_name(field):
    return F.url_decode(field)
