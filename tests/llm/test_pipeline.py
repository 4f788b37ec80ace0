"""The pipeline's stages on tables with every odd case, and the registered queries."""

import collections

import corpus_pipeline
import pytest
from leafstat.llm import lsh_forest
from leafstat.llm.common import landed
from leafstat.llm.queries import QUERIES, SQL

from small_tables import prose, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """A small copy of the tables' shape with near copies, junk and odd rows."""
    root = tmp_path_factory.mktemp("tables")
    base = prose(5, 200)
    rows = [(i, prose(1000 + i, 120)) for i in range(120)]
    rows += [(200 + i, base.replace(" ", f" w{i} ", 2)) for i in range(12)] + [(300 + i, base) for i in range(5)]
    rows += [(400 + i, " ".join(f"{w}***" for w in prose(i, 150).split())) for i in range(20)]
    rows += [(500, "again and again " * 60), (501, None), (502, ""), (503, "short text"), (None, prose(77, 90)), (10, rows[10][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 120, 2)] + [(400 + i, 0, 0) for i in range(0, 20, 2)]
    labels += [(i, 1, 0) for i in (*range(200, 212, 2), 300, 302)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes, kept = [docs.count()], {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = landed(stage(spark, docs, sf_dir), "stage")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        sizes.append(docs.count())
        if name != "best-fit packing":
            assert docs.columns == COLUMNS and docs.schema == before.schema
    clean = set(range(120)) - {0}
    assert len(kept["quality classifier"] & clean) > 0.95 * len(clean)
    assert not kept["quality rules"] & {*range(400, 420), 500, 501, 502, 503} and None in kept["quality rules"]
    near = kept["near duplicates"] & {*range(200, 212), *range(300, 305)}
    assert near == {min(kept["quality rules"] & {*range(200, 212), *range(300, 305)})}
    assert kept["best-fit packing"] == kept["near duplicates"]
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2]


def test_each_group_keeps_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stays = collections.Counter(r.doc_id for r in lsh_forest.representatives(docs).collect())
    classes = {r.class_id for r in lsh_forest.joined(docs).collect()}
    assert set(stays) == classes and max(stays.values()) == 1


def test_run_is_the_stages_in_turn(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    rooms = collections.defaultdict(int)
    for r in got:
        rooms[r.sequence_id] += r.length
    assert got and max(rooms.values()) <= 4096


def test_stages_on_empty_tables_and_clashing_columns(spark, sf_dir, odd, empty):
    for docs in (empty, odd):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, sf_dir)
            assert kept.columns == docs.columns
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert {r.doc_id for r in kept.select("doc_id").collect()} <= ids
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert (packed.count() == 0) == (docs is empty)


def test_landed_tables_are_released(spark, empty, odd):
    import os

    from leafstat.llm import common
    mark = common.landed_so_far()
    landed(odd.select("doc_id"), "a")
    kept = landed(odd.select("doc_id"), "b")
    gone = common._LANDED[mark].removeprefix("file:")
    assert os.path.isdir(gone) and common.release(spark, mark, keep=1) == 1
    assert not os.path.isdir(gone) and kept.count() == odd.count() and common.landed_so_far() == mark + 1
    assert common.release(spark, mark) == 1 and common.landed_so_far() == mark


def test_registered():
    import __spark_entry__ as entry
    found = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(found)
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_agrees(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    want = con.execute(SQL[name])
    columns = sorted(c[0] for c in want.description)
    rows = [dict(zip((c[0] for c in want.description), r)) for r in want.fetchall()]
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == columns
    key = lambda r: repr([r[c] for c in columns])
    assert sorted(map(key, rows)) == sorted(map(key, got.collect()))


def test_same_rows_in_any_order(spark, odd, odd_rows):
    shuffled = table(spark, odd_rows[::-1]).repartition(5)
    key = lambda d: sorted(repr(r) for r in lsh_forest.joined(d).collect())
    assert key(odd) == key(shuffled)
