"""Each stage on its own input against plain versions, and the whole run."""

from collections import Counter

import brute
import pytest

import corpus_pipeline as pipeline
from test_model_operators import labelled

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, hits string, rest string, toxic string, `group` string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with the tables that the stages read: a corpus with planted cases."""
    path = str(tmp_path_factory.mktemp("corpus"))
    texts, labels, truth = labelled(spark, 300)
    rows = [(r.doc_id, r.text) for r in texts.collect()]
    clean = [t for i, t in rows if i in truth and not truth[i][1]]
    rows += [(1000 + i, clean[3] + f" tail{i}") for i in range(3)] + [(1000, clean[3] + " tail0"), (1000, "another text of the same id")]
    rows += [(1100, f"before {clean[5]} after"), (1101, "mail a.b@mail.example.com or +1 (222) 555-1234 now"), (1102, "x " * 3000)]
    table = [(i, t, "en", "s", len(t) if t else None, "a", "b", "c", "d", "e") for i, t in rows]
    spark.createDataFrame(table, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("i1", clean[5]), ("i2", None)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        before, made = rows(docs), stage(spark, docs, folder)
        assert made.schema == docs.schema
        docs = pipeline.stored(made, name)
        after = rows(docs)
        if name == "toxicity":
            truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
            assert not after - before and all(truth.get(i) for i, _ in before - after)
            assert sum(bool(truth.get(i)) for i, _ in after) <= 3  # of 60; some single words are rare
        elif name == "near_duplicates":
            listed = sorted(before.elements(), key=repr)
            groups = {}
            for (i, _), (n, g) in zip(listed, brute.groups([t for _, t in listed], 5, 80, 100)):
                groups.setdefault((g, n > 0), []).append((i is None, i))
            assert sum(after.values()) == len(groups)
            assert Counter(i for i, _ in after.elements()) == Counter(min(x)[1] for x in groups.values())
        elif name == "decontamination":
            listed = list(before.elements())
            hit = brute.contamination([t for _, t in listed], [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
            assert after == Counter(x for x, h in zip(listed, hit) if not h[1])
        else:
            assert sum(after.values()) == sum(before.values())
            unchanged = {(i, t) for i, t in before if not t or not brute.personal(t)}
            assert all(x in after for x in unchanged)
            masks = [t for i, t in after if i == 1101]
            assert masks == ["mail [EMAIL] or [PHONE] now"]
            assert all(r.n_chars == len(r.text) for r in docs.filter("text is not null").collect())
    pieces = pipeline.packed(spark, docs, folder).collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(i for i, _ in after.elements())


def test_run_and_empty_tables(spark, folder):
    assert pipeline.run(spark, folder).count() > 0
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


