"""The registered queries and the pipeline, stage by stage against plain versions."""

import brute
import pytest

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in names if name.startswith("op")} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


@pytest.mark.parametrize("name", ["op6_decontamination", "op7_url_filter", "op11_sharding", "op12_prefix_trie", "op13_hard_negatives"])
def test_queries_agree_with_their_sql(spark, name):
    import __spark_entry__ as entry

    found = entry.queries()[name](spark, FOLDER)
    result = brute.oracle(FOLDER).execute(entry.oracle_sql()[name])
    assert brute.rows_of(found.columns, found.collect()) == brute.rows_of([c[0] for c in result.description], result.fetchall())


def test_simhash_query(spark):
    from tidemark.llm.queries import op2_simhash

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    prints = {i: brute.simhash(t) for i, t in texts.items()}
    wanted = {(i, f"{prints[i]:016x}", c) for i, c in brute.components(prints).items()}
    assert {tuple(r) for r in op2_simhash(spark, FOLDER).collect()} == wanted


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage kept, from documents on."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs.collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, FOLDER)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns and made.dtypes == docs.dtypes
        made.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        kept.append(docs.collect())
    return [{r["doc_id"]: r for r in rows} for rows in kept]


def test_stages(stages, spark):
    documents, good, lines, single, clean, coded = stages
    assert documents.keys() > good.keys() >= lines.keys() >= single.keys() >= clean.keys() == coded.keys() and coded
    assert all(not brute.base_statistics(documents[i]["text"])[-1] for i in good)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    lost = [i for i, q in labels.items() if q == 1 and i in documents and i not in good and not brute.base_statistics(documents[i]["text"])[-1]]
    assert not lost
    for i, r in lines.items():
        # neither a scrap nor a text of repeats is left, cut or not
        assert r["n_chars"] == len(r["text"]) and not brute.base_statistics(r["text"])[-1]
    prints = {i: brute.simhash(r["text"]) for i, r in lines.items()}
    assert single.keys() == {i for i, c in brute.components(prints).items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, _, n, _, _ in brute.decontamination([(i, r["text"]) for i, r in single.items()], items) if n}
    assert clean.keys() == single.keys() - hit
    ids = brute.library_ids([r["text"] for r in clean.values()])
    assert all(coded[i]["token_ids"] == x and coded[i]["round_trip"] and coded[i]["n_tokens"] == len(x) for i, x in zip(clean, ids))


def test_run_is_all_stages(stages, spark):
    assert {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()} == stages[-1]


def test_odd_tables_pass_through(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, token_ids string, _sha string, decoded string, s_id string"
    long = " ".join(f"word{i}" for i in range(300))
    more = "sha", "bytes", "s"
    rows = [(1, None, None, None, None, None, *more), (2, "", "en", "s", 0, "x", *more), (3, long, "en", "s", 1, "x", *more),
            (3, long, "en", "s", 1, "x", *more), (None, long, None, None, 1, None, *more)]
    for n, some in (("some", rows), ("none", [])):
        folder = f"{tmp_path}/{n}"
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, folder).collect()
        # the null id comes first, so the rows of id 3 hold nothing new
        assert [r["doc_id"] for r in found] == ([None] if some else [])
        assert [(r["_sha"], r["decoded"], r["s_id"]) for r in found] == ([more] if some else []) and all(r["round_trip"] for r in found)


def test_scraps_of_long_texts(spark):
    """The rules of cut texts count each text's words once, not once for each word (which never ends for these)."""
    from threading import Timer

    words = [f"w{i * 7919 % 100003}" for i in range(9000)]
    texts = [" ".join(words[:4000]), " ".join(words[3000:]), " ".join(words[3000:3100] + ["few", "more"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    timer = Timer(120, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        found = {r["doc_id"]: r["text"].split() for r in corpus_pipeline.lines(spark, docs, None).collect()}
    finally:
        timer.cancel()
    assert found == {0: words[:4000], 1: words[4000:]}


def test_cut_lines_hold_each_text_once(spark, monkeypatch):
    held, stored = {}, corpus_pipeline.stored

    def listed(df, name):
        held[name] = df.columns
        return stored(df, name)

    monkeypatch.setattr(corpus_pipeline, "stored", listed)
    words = " ".join(f"word{i}" for i in range(200))
    docs = spark.createDataFrame([(0, words), (1, words + " more"), (2, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.lines(spark, docs, None).collect()] == [0, 2]
    assert held["cut-lines"] == ["row", "spans"]
