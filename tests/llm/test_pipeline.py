"""The pipeline's stages one by one on a small corpus, and the whole."""

import random

import pytest

import corpus_pipeline
from tests_llm_help import docs_table, plain_components, prose


@pytest.fixture(scope="module")
def corpus():
    r, rows = random.Random(3), []
    for i in range(120):
        text = prose(i, 40) + (" you idiot moron" if i % 4 == 0 else "")
        rows.append((i, text, "en", "ab"[i % 2], len(text)))
    for i in range(120, 140):  # copies and near copies of clean documents
        w = rows[4 * (i - 120) + 1][1].split()
        if i % 2:
            w[20] = "changed"
        rows.append((i, " ".join(w), "en", "a", 0))
    key = "".join(r.choices("abcdef0123456789", k=40))
    rows += [(200, f"see token = {key} and more", "en", None, 1), (201, None, "en", "b", None), (202, "", None, "b", 0), (None, prose(900, 12), "en", "b", 1), (None, prose(900, 12), "en", "b", 1), (203, "日本語 🎉 text", "ja", "b", 9)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    docs_table(spark, corpus).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_toxicity_stage_drops_what_is_toxic_only(spark, corpus, folder):
    got = {(r["doc_id"], r["text"]) for r in stage("toxicity")(spark, docs_table(spark, corpus), folder).collect()}
    assert got == {(i, t) for i, t, *_ in corpus if not (t and "idiot" in t)}


def test_join_stage_keeps_one_of_each_group(spark, corpus, folder):
    out = stage("ngram_jaccard")(spark, docs_table(spark, corpus), folder)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    named = [(i, t) for i, t, *_ in corpus if i is not None]
    root = plain_components(named)
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == sorted(i for i, t in named if not t or root[i] == i)
    assert sum(r["doc_id"] is None for r in rows) == 1


def test_secret_stage_keeps_all_rows_and_other_text(spark, corpus, folder):
    rows = stage("secret_scan")(spark, docs_table(spark, corpus), folder).collect()
    assert len(rows) == len(corpus)
    got = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    assert got == {i: "see [secret] and more" if i == 200 else t for i, t, *_ in corpus if i is not None}


def test_mixing_stage_meets_targets(spark, corpus, folder):
    size = lambda t: len((t or "").split())
    total = {}
    for _, t, _, s, _ in corpus:
        total[s] = total.get(s, 0) + size(t)
    got = {}
    for r in stage("mix_sources")(spark, docs_table(spark, corpus), folder).collect():
        got[r["source"]] = got.get(r["source"], 0) + size(r["text"])
    # weights 5, 2, 1 for a, b, null; null stops at three times its words, the rest is shared 5 to 2
    rest = sum(total.values()) - 3 * total[None]
    want = {"a": rest * 5 / 7, "b": rest * 2 / 7, None: 3 * total[None]} if sum(total.values()) / 8 > 3 * total[None] else {}
    assert want
    assert {s: pytest.approx(n, abs=1) for s, n in want.items()} == got


def test_the_whole_is_its_stages_and_round_trips(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert set(rows[0].asDict()) == {"doc_id", "lang", "source", "n_tokens", "ids", "round_trip"}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    ids = {r["doc_id"] for r in rows}
    assert not any(i is not None and i < 120 and i % 4 == 0 for i in ids)  # toxic
    assert not any(i is not None and 120 <= i < 140 and i % 2 == 0 for i in ids)  # copies


def test_the_stages_take_an_empty_table(spark, corpus, folder):
    none = docs_table(spark, [])
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, none, folder).count() == 0, name
