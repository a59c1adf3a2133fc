"""Benchmark decontamination by a positional inverted index.

The index stores a posting (term, document, position) for every occurrence of a test term in the documents;
other terms can't be asked for. A window is matched from its rarest terms: their lists, shifted by the term's
place in the item, must meet on one diagonal (document position minus item position). Only such diagonals are
then intersected with the lists of all other terms, and runs of a window's length are exact phrase matches.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, bounded_broadcast, keyed, same_document, stored

#: Fixed value: what separates words once A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lists that must meet before the others are looked at.
RAREST = 2
DOC, ITEM = ["id", "mark"], ["item", "item_mark"]


def words_of(text):
    return F.array_remove(F.split(ascii_lower(text), GAP), "")


class Index:
    """Postings of the test terms, and the items in terms; both tables in the shared folder."""

    def __init__(self, docs, items, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"):
        tests = keyed(items, item_col, item_text_col).select(
            F.col("id").alias("item"), F.col("mark").alias("item_mark"), words_of("text").alias("words")).distinct()
        spelled = tests.select(*ITEM, F.size("words").alias("length"), F.posexplode("words").alias("at", "word"))
        terms = stored(spelled.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "test-terms")
        size = terms.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.octet_length("word")), F.lit(0)).alias("b")).first()
        few_terms = bounded_broadcast(terms, size["n"], size["b"] + 64)
        self.items = stored(spelled.join(few_terms, "word").drop("word"), "test-items")
        self.n_item_words = self.items.count()
        occurrences = keyed(docs, id_col, text_col).select(*DOC, F.posexplode(words_of("text")).alias("pos", "word"))
        self.postings = stored(occurrences.join(few_terms, "word").select("term", *DOC, "pos"), "postings")

    def frequencies(self):
        """term, n of each term that occurs."""
        return self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))

    def small(self, item_rows):
        """item_rows marked for broadcast if the items are few enough; they have at most a row for each item word."""
        return bounded_broadcast(item_rows, self.n_item_words, 96)


def _windows(index, length):
    """item, start, at, term, n: the words of each window that has no word absent from the documents."""
    within = F.least("length", F.lit(length))
    starts = F.sequence(F.greatest(F.lit(0), F.col("at") - within + 1), F.least("at", F.col("length") - within))
    rows = index.items.join(index.small(index.frequencies()), "term", "left").select(
        *ITEM, "length", "at", "term", F.coalesce("n", F.lit(0)).alias("n"), F.explode(starts).alias("start"))
    whole = Window.partitionBy(*ITEM, "start")
    return rows.withColumn("least", F.min("n").over(whole)).where("least > 0").drop("least")


def _matched(index, expected):
    """expected (document, pos, term, ...) that the postings hold. The documents asked for are broadcast while they
    are few; else both sides are shuffled."""
    wanted = stored(expected, "expected-postings")
    asked = wanted.select(*DOC).distinct()
    few = bounded_broadcast(asked, asked.count(), 48)
    held = index.postings
    if few is not asked:
        held = held.join(few, same_document(held, few), "left_semi")
    held = held.select(F.col("id").alias("p_id"), F.col("mark").alias("p_mark"), F.col("pos").alias("p_pos"), F.col("term").alias("p_term"))
    return wanted.join(held, F.col("id").eqNullSafe(F.col("p_id")) & F.expr("mark = p_mark and pos = p_pos and term = p_term"),
                       "left_semi")


def phrase_matches(index, length=10):
    """id, mark, item, item_mark, start, end of every run of an item's words in a document that is at least
    `length` words long, or the whole of a shorter item; end exclusive, positions in words. Runs that an item
    has in a document at different places are rows of their own."""
    windows = _windows(index, length)
    ranked = windows.withColumn("rank", F.row_number().over(Window.partitionBy(*ITEM, "start").orderBy("n", "at")))
    anchors = ranked.where(F.col("rank") <= RAREST).select(*ITEM, "length", "at", "term").distinct()
    shifted = index.postings.join(index.small(anchors), "term").select(*DOC, *ITEM, "length", (F.col("pos") - F.col("at")).alias("diagonal"), "at")
    diagonals = shifted.groupBy(*DOC, *ITEM, "length", "diagonal").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    diagonals = diagonals.where((F.col("low") < F.col("high")) | (F.least("length", F.lit(length)) < RAREST))
    items = index.small(index.items.select(F.col("item").alias("i"), F.col("item_mark").alias("im"), "at", "term"))
    reach = F.col("at").between(F.col("low") - (length - 1), F.col("high") + (length - 1))
    expected = (
        diagonals.join(items, F.col("item").eqNullSafe(F.col("i")) & (F.col("item_mark") == F.col("im"))).where(reach)
        .select(*DOC, *ITEM, "length", "diagonal", "at", "term", (F.col("diagonal") + F.col("at")).alias("pos")).where("pos >= 0")
    )
    found = _matched(index, expected)
    along = [*DOC, *ITEM, "length", "diagonal"]
    runs = found.withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy(*along).orderBy("at")))
    runs = runs.groupBy(*along, "run").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"))
    return runs.where(F.col("end") - F.col("start") >= F.least("length", F.lit(length))).select(*DOC, *ITEM, "start", "end")


def proximity_matches(index, slop):
    """id, mark, item, item_mark, origin, start, end of every place where each word of an item lies at most `slop`
    words from where the item's rarest word puts it (0: the item itself). origin: where the item would begin."""
    words = index.items.join(index.small(index.frequencies()), "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    whole = Window.partitionBy(*ITEM)
    words = words.withColumn("least", F.min("n").over(whole)).where("least > 0").withColumn(
        "rank", F.row_number().over(whole.orderBy("n", "at")))
    rarest = words.where("rank = 1").select(*ITEM, "length", "at", "term")
    origins = index.postings.join(index.small(rarest), "term").select(*DOC, *ITEM, "length", (F.col("pos") - F.col("at")).alias("origin"))
    items = index.small(index.items.select(F.col("item").alias("i"), F.col("item_mark").alias("im"), "at", "term"))
    places = origins.join(items, F.col("item").eqNullSafe(F.col("i")) & (F.col("item_mark") == F.col("im"))).select(
        *DOC, *ITEM, "length", "origin", "at", "term", F.explode(F.sequence(
            F.col("origin") + F.col("at") - slop, F.col("origin") + F.col("at") + slop)).alias("pos")).where("pos >= 0")
    found = _matched(index, places)
    return found.groupBy(*DOC, *ITEM, "length", "origin").agg(
        F.count_distinct("at").alias("n"), F.min("pos").alias("start"), (F.max("pos") + 1).alias("end")
    ).where("n = length").select(*DOC, *ITEM, "origin", "start", "end")


def contamination(docs, items, length=10, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"):
    """id, mark, n_words, n_hit, items (sorted array of the items' ids as text) of every row of docs.

    n_hit: words inside any match. Null and empty texts have no words; items without a word match nothing, and
    an item given twice counts once. Other columns of docs and items are ignored.
    """
    index = Index(docs, items, id_col, text_col, item_col, item_text_col)
    spans = stored(phrase_matches(index, length), "phrase-matches")
    before = Window.partitionBy(*DOC).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    hit = spans.select(*DOC, "item", F.greatest(F.col("end") - reached, F.lit(0)).alias("new")).groupBy(*DOC).agg(
        F.sum("new").cast("long").alias("n_hit"), F.array_sort(F.collect_set(F.coalesce(F.col("item").cast("string"), F.lit("")))).alias("items"))
    hit = hit.select(F.col("id").alias("h_id"), F.col("mark").alias("h_mark"), "n_hit", "items")
    rows = keyed(docs, id_col, text_col).select(*DOC, F.size(words_of("text")).cast("long").alias("n_words"))
    return rows.join(hit, F.col("id").eqNullSafe(F.col("h_id")) & (F.col("mark") == F.col("h_mark")), "left").select(
        *DOC, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def keep_clean(docs, items, length=10, id_col="doc_id", text_col="text"):
    """The rows of docs, all columns, that hold no window of an item."""
    index = Index(docs, items, id_col, text_col)
    hit = phrase_matches(index, length).select(*DOC).distinct()
    rows = docs.select(F.struct("*").alias("_row"), docs[id_col].alias("id"),
                       F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("mark"))
    return rows.join(hit, same_document(rows, hit), "left_anti").select("_row.*")
