"""The pipeline's stages on a small corpus: what must go goes, what is clean stays."""
import numpy as np
import pytest

import corpus_pipeline


def prose(seed, n):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 3000, n)]


def test_stages(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    passage, item = prose(1, 60), prose(2, 20)
    rows = [(i, " ".join(prose(1000 + i, 80))) for i in range(60)] + [(i, " ".join(prose(1000 + i, 70) + ["vileness"] * (i % 4 == 0))) for i in range(400, 800)]
    rows += [(i, " ".join(prose(1000 + i, 60) + ["vileness"])) for i in range(60, 90)]
    rows += [(200, rows[7][1]), (201, " ".join(prose(300, 80)) + "\n" + " ".join(passage)), (202, " ".join(passage) + "\n" + " ".join(prose(301, 80))), (203, " ".join(prose(302, 50) + item + prose(303, 20)))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(60 <= i < 90 or i >= 400 and i % 4 == 0)) for i in [*range(90), *range(400, 800)]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = kept
        assert k == len(corpus_pipeline.STAGES) - 1 or kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda name: {r.doc_id for r in seen[name].select("doc_id").collect()}
    clean = set(range(60)) | {i for i in range(400, 800) if i % 4} | {200, 201, 202, 203}
    assert len(ids("toxicity") & set(range(60, 90))) <= 3 and len(clean - ids("toxicity")) <= 1
    assert 200 not in ids("n-gram Jaccard join") and 7 in ids("n-gram Jaccard join")
    texts = {r.doc_id: r for r in seen["substring dedup"].collect()}
    assert texts[201].text.endswith(passage[-1]) and passage[0] not in texts[202].text.split("\n")[0].split()[:1] and texts[202].n_chars == len(texts[202].text)
    assert 203 in ids("substring dedup") and 203 not in ids("benchmark decontamination")
    assert ids("BPE encoding and decoding") == ids("benchmark decontamination")


def test_near_copies_by_row(spark, tmp_path):
    text = lambda k: " ".join(prose(2000 + k, 60))
    rows = [(1, text(1)), (2, text(1)), (2, text(2)), (3, text(3)), (3, text(4)), (3, text(4)), (4, None), (4, ""), (4, text(5)), (5, text(5)), (None, text(6)), (None, text(6)), (None, text(1)), (None, None)]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text or "-") for r in kept.collect()))
    assert got == sorted([(1, text(1)), (2, text(2)), (3, text(3)), (3, text(4)), (4, "-"), (4, "-"), (4, text(5)), (0, text(6)), (0, "-")])


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, equal rows, ties, and columns named as the stages might name theirs."""
    pytest.importorskip("public_tokenizers")
    words = prose(9, 30_000)
    texts = [None, "", " \n\t", " ".join(words), " ".join(prose(11, 80)), "one two"]
    rows = [(i, t, None, None, None, 0.5, "k", 7, "d") for i, t in enumerate(texts)] + [(None, t, "en", "s", 1, None, None, None, None) for t in texts] + [(4, texts[4], None, None, None, 0.5, "k", 7, "d")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, `spans` string, predicted int, doc string"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(words[500:515])), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    row = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "", r.spans or "")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = sorted(map(row, out.collect()))
    everything = sorted(map(row, docs.collect()))
    assert seen["toxicity"] == everything  # no positive to learn from
    # Of the long text, the near copies without a doc_id, and the equal rows one each stays; texts without words are no one's copies.
    assert [r[:2] for r in seen["n-gram Jaccard join"]] == [(False, i) for i in range(6)] + [(True, 0)] * 3
    assert [r[:2] for r in seen["substring dedup"]] == [r[:2] for r in everything]
    assert [r for r in everything if len(r[2]) > 10_000] == sorted(set(everything) - set(seen["benchmark decontamination"]))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.count() == len(rows) and last.columns[0] == "doc_id"


def test_empty(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pytest.importorskip("public_tokenizers")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
