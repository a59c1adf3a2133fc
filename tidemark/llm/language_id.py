"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of its labelled texts. A text is compressed with
each of them, in blocks, and the language of the smallest result wins; a narrow margin is reported as a
rejection. Block sizes add up as code lengths: 8 bits a byte give the languages' posterior.
"""

import re
from dataclasses import dataclass, field
from functools import lru_cache

import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.chunks import sliced, texts_of
from tidemark.llm.common import in_arrow

LETTER = regex.compile(r"\p{L}")
#: What stands between words: signs and digits say nothing of the language.
BETWEEN = re.compile(r"[\W\d_]+")
#: Bytes compressed at a time, so that the dictionary counts throughout a long text.
BLOCK = 4096


@dataclass(frozen=True)
class LanguageModel:
    """Dictionary bytes by language, most frequent language first."""

    dictionaries: tuple = field(default_factory=tuple)
    level: int = 6

    @property
    def languages(self):
        return [lang for lang, _ in self.dictionaries]


def fit(docs, lang_col="lang", id_col="doc_id", text_col="text", samples=96, sample_chars=2048, level=6):
    """Learn from every row that has a language, a text and an id.

    A language's dictionary is a bounded sample: `samples` rows, the one of least hash in each of as many hash
    bins, `sample_chars` characters of each from a place its hash names. Rows are counted and chosen by two aggregations with a
    partial step, so a language that owns most rows is no hot key; only the sample reaches the driver.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(id_col), F.lit(7)).alias("h"))
    binned = rows.withColumn("bin", F.pmod("h", F.lit(samples)))
    chosen = binned.groupBy("lang", "bin").agg(F.min("h").alias("h"), F.count(F.lit(1)).alias("n"))
    chosen = [(r["lang"], r["h"], r["n"]) for r in chosen.collect()]  # at most `samples` a language
    if not chosen:
        return LanguageModel((), level)
    counts = {}
    for lang, _, n in chosen:
        counts[lang] = counts.get(lang, 0) + n
    keys = docs.sparkSession.createDataFrame([(lang, h) for lang, h, _ in chosen], "lang string, h long")
    start = (F.pmod("h", F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1) + 1).cast("int")
    texts = (rows.join(F.broadcast(keys), ["lang", "h"])
             .groupBy("lang", "h").agg(F.min(F.substring("text", start, F.lit(sample_chars))).alias("text")).collect())
    content = {lang: [] for lang in counts}
    for r in sorted(texts, key=lambda r: r["h"]):
        content[r["lang"]].append(plain(r["text"]))
    ranked = sorted(content, key=lambda lang: (-counts[lang], lang))
    return LanguageModel(tuple((lang, "\n".join(content[lang]).encode()) for lang in ranked), level)


def plain(text):
    """Lower case, with one space for whatever stands between words."""
    return BETWEEN.sub(" ", text).lower()


@lru_cache(4)
def _compressors(model):
    import zstandard

    made = []
    for _, content in model.dictionaries:
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        parameters = zstandard.ZstdCompressionParameters.from_level(
            model.level, write_content_size=False, write_checksum=False, write_dict_id=False)
        made.append(zstandard.ZstdCompressor(dict_data=shared, compression_params=parameters))
    return made


def classify(model, text, margin=0.02):
    """(language, score, rejected) of one text; ('und', 0.0, True) where there is no letter or no model."""
    if not model.dictionaries or not LETTER.search(text):
        return "und", 0.0, True
    data = plain(text).encode()
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for c in _compressors(model)]
    best = min(sizes)
    score = 1.0 / sum(256.0 ** max(best - s, -100) for s in sizes)
    rest = sorted(sizes)[1:]
    rejected = bool(rest) and rest[0] - best < max(1.0, margin * best)
    return model.languages[sizes.index(best)], score, rejected


def identify(docs, model, id_col="doc_id", text_col="text", margin=0.02):
    """doc_id, lang, score (0 to 1), rejected of every row.

    `lang` is the language of the smallest result (ties: the one with more training rows, then by name), `und`
    where the text is null, empty or without a letter. `rejected` marks `und` and results that lead the next
    best by less than `margin` of their size. Whole texts are read; other columns of docs are ignored.
    """
    out = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by samples x sample_chars a language

    def identified(batches):
        import pyarrow as pa

        for part in (p for batch in batches for p in sliced(batch, 1, 1 << 20)):
            found = [classify(shared.value, t, margin) for t in texts_of(part.column(1))]
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())], names=out.names)

    return in_arrow(docs.select(docs[id_col], F.col(text_col).cast("binary")), identified, out)
