"""Each stage of the pipeline and all of them, against plain Python."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_operators import plain_components, plain_hits, texts_of, twice

import corpus_pipeline
from kindred import session
from kindred.llm import packing, pseudonyms

ITEMS = [(1, "anis sted stly " * 5), (2, "one two"), (3, ""), (4, None)]


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    """documents, labels and benchmark, with copies, nulls, empty texts, a long one, personal data and a document of a benchmark item."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    more = [(300, "wh " + ITEMS[0][1] + "at", "en"), (301, "call +49 30 1234 5678 or mail a.b@example.org, card 4539 5787 6362 1486", "en"), (None, "one of a kind text without an id 4539 5787 6362 1486", "en"), (None, None, None)]
    docs = corpus.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    twice(docs).write.parquet(f"{path}/documents.parquet")
    labels = corpus.where("doc_id < 160").select("doc_id", F.coalesce(F.col("text").contains("idiot"), F.lit(False)).cast("int").alias("toxic"))
    labels.union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int")).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_toxic_documents_go_and_clean_ones_stay(spark, folder, docs):
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns and not rows_of(kept) - rows_of(docs)
    left = {t for _, t in texts_of(kept)}
    toxic = {t for _, t in texts_of(docs) if t and "idiot" in t}
    clean = {t for _, t in texts_of(docs)} - toxic
    assert len(toxic & left) <= 1 and len(clean - left) <= 1
    assert left >= {None, "", " \n ", "12 + 7!"}


def test_one_of_each_group_of_near_copies_stays(spark, folder, docs):
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, folder)
    own = [(i, t) for i, t in texts_of(docs) if i is not None]
    want = plain_components(own, 5, 80)
    assert kept.columns == docs.columns and not rows_of(kept) - rows_of(docs)
    assert {i for i, _ in texts_of(kept) if i is not None} == {i for i, (_, least) in want.items() if i == least}
    assert sum(i is None for i, _ in texts_of(kept)) == 2
    assert Counter(i for i, _ in texts_of(kept))[3] == (2 if want[3][1] == 3 else 0)


def test_documents_of_the_benchmark_go(spark, folder, docs):
    kept = corpus_pipeline.drop_benchmark(spark, docs, folder)
    long, short = ([(i, t) for i, t in ITEMS if t and (len(t.split()) >= 5) == side] for side in (True, False))
    gone = {i for i, _, _, _, _, hit in plain_hits(texts_of(docs), long, 10) if hit}
    gone |= {i for i, n, n_hit, _, _, _ in plain_hits(texts_of(docs), short, 10) if n_hit > 0.5 * n}
    assert {300, 205, 206} <= gone
    assert kept.columns == docs.columns and rows_of(kept) == rows_of(docs.where(~F.coalesce(F.col("doc_id").isin(sorted(gone - {None})), F.lit(False))))


def test_personal_data_is_hidden_in_every_document(spark, folder, docs):
    kept = corpus_pipeline.hide_personal_data(spark, docs, folder)
    using = pseudonyms.Pseudonyms(pseudonyms.TEST_KEY)
    want = Counter((i, t if t is None else pseudonyms.pseudonymise_text(t, using)[0]) for i, t in texts_of(docs))
    assert kept.columns == docs.columns and Counter(texts_of(kept)) == want
    assert not any(t and ("4539 5787" in t or "a.b@" in t) for _, t in texts_of(kept))
    spark.conf.set(pseudonyms.KEY_SETTING, "another")
    other = texts_of(corpus_pipeline.hide_personal_data(spark, docs, folder))
    spark.conf.unset(pseudonyms.KEY_SETTING)
    assert Counter(other) != want


def pieces_of(texts):
    encode = packing.encoder(None)
    for i, t in texts:
        ids = encode(t or "") + (1).to_bytes(4, "little")
        for k, at in enumerate(range(0, len(ids), 4 * 4096)):
            part = ids[at : at + 4 * 4096]
            yield i, k, at // 4, len(part) // 4, zlib.crc32(part)


def check_packed(rows, texts):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(pieces_of(texts))
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 4096


def test_all_stages_after_one_another(spark, folder, docs):
    """run() gives what the stages give one by one, each on what the one before it kept."""
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = spark.createDataFrame(stage(spark, left, folder).collect(), docs.schema)
        assert left.columns == docs.columns, name
    packed = corpus_pipeline.run(spark, folder).collect()
    check_packed(packed, texts_of(left))
    assert {300, 301} & {r.doc_id for r in packed} == {301}


def test_empty_tables(spark, folder, docs, tmp_path):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        (table if name == "documents" else table.limit(0)).write.parquet(f"{tmp_path}/{name}.parquet")
    for _, stage in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[2]):
        assert rows_of(stage(spark, docs, str(tmp_path))) == rows_of(docs)


def test_batches_of_whole_documents_are_bounded(spark, folder, docs):
    # What `settle` has written came to the workers in small batches; a frame that the caller writes would not.
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.hide_personal_data):
        assert getattr(stage(spark, docs, folder), "_kindred_path", None)


def test_a_worker_gives_memory_back_at_its_end(monkeypatch):
    trimmed = []
    monkeypatch.setattr(session.ctypes, "CDLL", lambda _: type("C", (), {"malloc_trim": staticmethod(trimmed.append)}))
    rows = session.lean(iter)([1, 2])
    assert next(rows) == 1 and not trimmed
    assert list(rows) == [2] and trimmed == [0]
