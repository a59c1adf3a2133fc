"""Cutting text where a byte-level tokenizer is bound to cut it too; batches balanced by bytes."""

import re

#: The white space of Unicode, as \s of the tokenizers' pattern has it.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space and the word after it. A token never holds a word and the white space that follows it, and what
#: follows a cut is matched without looking back, so each chunk is encoded alone as it is within its text.
CHUNK = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")


def chunks_of(text):
    return CHUNK.findall(text)


def by_bytes(sizes, limit):
    """(start, stop) of consecutive runs of about `limit` bytes each; a larger item is a run of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def texts_of(column):
    """Python strings of an Arrow column of UTF-8 bytes; broken bytes become U+FFFD, null is empty."""
    return [b.decode("utf-8", "replace") if b else "" for b in column.to_pylist()]


def sliced(batch, column, limit):
    """An Arrow batch in parts of about `limit` bytes of that column, so that few texts are Python objects at a time."""
    import pyarrow.compute as pc

    for start, stop in by_bytes(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist(), limit):
        yield batch.slice(start, stop - start)
