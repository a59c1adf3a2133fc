"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries (chunks.CHUNK; very long words also where letters end), and a worker
remembers the length of each chunk it has encoded, up to a bound. Chunks it hasn't seen are encoded in
batches of about `batch_bytes` bytes, so neither many short nor a few long texts make a batch heavy.
"""

import os
from functools import lru_cache

import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.chunks import by_bytes, chunks_of, sliced, texts_of
from tidemark.llm.common import in_arrow

#: A chunk of more characters is cut further, each time letters end.
LONG_CHUNK = 4096
AFTER_LETTERS = regex.compile(r"\P{L}*\p{L}+|\P{L}+")
#: Chunks a worker remembers at most; when full it forgets all of them and goes on.
REMEMBERED = 400_000


class Lengths:
    """Token counts of texts by one vocabulary file."""

    def __init__(self, path, batch_bytes):
        self.batch_bytes, self.known = batch_bytes, {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            self.special, self.cuts = None, False
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.encode = lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            added = sorted((t.content for t in model.get_added_tokens_decoder().values()), key=len, reverse=True)
            self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
            self.cuts = model.normalizer is None and "ByteLevel" in type(model.pre_tokenizer).__name__

    def parts(self, text):
        if not self.cuts:
            return [text] if text else []
        if self.special is None or not self.special.search(text):
            spans = [text]
        else:  # a special string is one token and cuts the text
            spans, at = [], 0
            for m in self.special.finditer(text):
                spans += [text[at : m.start()], m[0]]
                at = m.end()
            spans.append(text[at:])
        parts = []
        for span in spans:
            for chunk in chunks_of(span):
                if len(chunk) > LONG_CHUNK:
                    parts += AFTER_LETTERS.findall(chunk)
                else:
                    parts.append(chunk)
        return parts

    def of(self, texts):
        split = [self.parts(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({p for parts in split for p in parts if p not in known})
        for start, stop in by_bytes([len(p) for p in new], self.batch_bytes):
            known.update(zip(new[start:stop], self.encode(new[start:stop])))
        counts = [sum(map(known.__getitem__, parts)) for parts in split]
        if not self.cuts:
            known.clear()
        return counts


@lru_cache(4)
def _lengths(path, batch_bytes):
    return Lengths(path, batch_bytes)


def token_counts(docs, path, id_col="doc_id", text_col="text", batch_bytes=1 << 20):
    """doc_id, n_bytes, n_tokens of every row, in whatever order and however often it occurs.

    path: a tokenizer file that every executor has (.json for tokenizers, .model for sentencepiece). Null and
    empty texts have 0 bytes and 0 tokens; special strings within a text count as the library's default has it.
    Other columns of docs are ignored.
    """
    out = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ])

    def lengths(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        counter = _lengths(path, batch_bytes)
        for part in (p for batch in batches for p in sliced(batch, 1, batch_bytes)):
            sizes = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
            counts = counter.of(texts_of(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array(counts, pa.int64())], names=out.names)

    return in_arrow(docs.select(docs[id_col], F.col(text_col).cast("binary")), lengths, out)
