"""Clustering by tables, language-model scoring and collocations on small tables, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import attention
from panelforge.llm.attention import CONTEXT, SPAN, gradient, initial, log_probabilities, unpacked_weights, vocabulary, windows
from panelforge.llm.centroids import centroid_clusters, nearest
from panelforge.llm.lm_scoring import lm_scores
from panelforge.llm.phrases import collocations
from panelforge.llm.secrets import outside, redacted, secret_digests
from panelforge.llm.sentencepiece import DEFAULT_MODEL, Encoder, Pieces
from panelforge.llm.textvec import SLICE_BYTES, Words, bytes_in
from tests_llm_help import docs_table

DOCS = "doc_id long, text string, lang string, source string, key long, phrase string, f long, bucket int, score double, n_tokens long"  # with clashing names
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "p", 2, 3, 0.5, 4) for i, t, lang in rows], DOCS)


def babble(seed, n, vocabulary=12):
    r = random.Random(seed)
    return "".join(r.choice(["ka", "lo", "MI", "ren", "tu", "so", "pel", "da", "ix", "vor", "ne", "qua"][:vocabulary]) + r.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "ta "]) for _ in range(n))


# clustering ------------------------------------------------------------------


def plain_clusters(rows, k, rounds):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(b"1:" + (b"" if r[0] is None else str(r[0]).encode())).hexdigest(), r[1]))[:k]
    m = [list(v) for _, v in first]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min(range(len(m)), key=lambda c: (far(v, m[c]), c))
    for _ in range(rounds):
        at = [near(v) for _, v in kept]
        for c in set(at):
            own = [v for (_, v), x in zip(kept, at) if x == c]
            m[c] = [sum(col) // len(own) for col in zip(*own)]
    out = [(i, near(v)) for i, v in kept]
    dist = [far(v, m[c]) for (_, v), (_, c) in zip(kept, out)]
    return sorted(((i, c, d, sum(e for (_, x), e in zip(out, dist) if x == c), sum(dist), hashlib.sha256(",".join(map(str, m[c])).encode()).hexdigest()) for (i, c), d in zip(out, dist)), key=repr)


def clusters(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance double")
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in centroid_clusters(df, dims=4, **options).collect()), key=repr)


def test_clusters_match_brute_force_on_odd_rows(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=4)]) for i in range(300)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (901, None), (902, [1.0] * 3), (903, [1.0, None, 0.0, 0.0]), (904, [math.nan] * 4), (905, [math.inf, 0.0, 0.0, 0.0]), (906, []), (907, [-0.015625, 0.0, 5000.25, -7000.5])]
    assert clusters(spark, rows, clusters=7, rounds=3) == plain_clusters(rows, 7, 3)
    assert clusters(spark, rows[:3], clusters=7, rounds=2) == plain_clusters(rows[:3], 7, 2)
    assert clusters(spark, [], clusters=7) == clusters(spark, [(1, None)], clusters=7) == []


def test_ties_go_to_the_smaller_number_and_large_components_fit():
    c, d = nearest(np.array([[0, 0], [4, 0]]), np.array([[2, 0], [2, 0], [-2, 0]]))
    assert c.tolist() == [0, 0] and d.tolist() == [4, 4]
    big = np.array([[1 << 26] * 64, [-(1 << 26)] * 64])
    assert nearest(big, big[:1])[1].tolist() == [0, 64 << 54]


# collocations ----------------------------------------------------------------


def plain_collocations(rows, least, top):
    counts = {}
    for _, text, lang in rows:
        c = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in range(1, 6):
                c.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        n = sum(f for p, f in c.items() if len(p) == 1)
        cand = {p: f for p, f in c.items() if len(p) > 1 and f >= least}
        inside = {q for p, f in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) for q in [p[i : i + k]] if f >= cand[q]}
        best = []
        for p, a in cand.items():
            if p not in inside:
                score, _, left, right = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), " ".join(p), a, left, right, n, score))
        out += [(lang, i + 1, *b[3:]) for i, b in enumerate(sorted(best)[:top])]
    return sorted(out)


def phrases(spark, rows, **options):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in collocations(docs(spark, rows), **options).collect())


def test_collocations_match_brute_force(spark):
    rows = [(i, babble(i, 120, 5 + i % 7), ["en", "de", None, "und"][i % 4]) for i in range(40)]
    rows += [(7, rows[7][1], rows[7][2])] * 5 + [(50, None, "en"), (51, "", "en"), (52, " ., \n", "xx"), (53, "Straße ÄÖ straße ÄÖ  Straße x ÄÖ " * 9, "de"), (None, "a a a a a a a a a a", "rep")]
    for least, top in ((3, 2000), (8, 7)):
        assert phrases(spark, rows, min_count=least, top=top) == plain_collocations(rows, least, top)
    assert phrases(spark, [], min_count=2) == []


def test_collocations_of_a_text_of_megabytes(spark):
    text = " ".join(babble(k, 60) for k in range(4)) * 1200  # one piece after the other, cut into many blocks
    assert len(text) > 4 * SLICE_BYTES
    rows = [(1, text, "en"), (2, "x" * (3 * SLICE_BYTES), "en")]
    assert phrases(spark, rows, min_count=900, top=50) == plain_collocations(rows, 900, 50)


def test_words_are_the_same_however_texts_are_cut():
    gaps = bytes_in(b" \t\n\x0b\x0c\r")
    long = " ".join(f"W{k % 977}" for k in range(200_000)).encode()
    w = Words([b"", b"One  two", long, b" \n ", b"three"], gaps)
    assert np.diff(w.first).tolist() == [0, 2, 200_000, 0, 1]
    assert w.strings(np.array([0, 1, 2, 978, 200_002])).to_pylist() == ["one", "two", "w0", "w976", "three"]
    assert len(np.unique(w.hashes)) == 977 + 3


# language model --------------------------------------------------------------


@pytest.fixture(scope="module")
def small():
    r = np.random.default_rng(4)
    counts = np.append(np.where(np.arange(40) % 5 == 0, 0, r.integers(1, 90, 40)), 12)
    v = vocabulary(counts, np.concatenate((r.random((40, 9)), np.zeros((1, 9)))), groups=4, members=5)
    return v, initial(v, 6)


def test_a_model_gives_probabilities(small):
    v, flat = small
    w = unpacked_weights(flat, v, 6)
    for begun in ([], [3, 7, 7], list(range(1, 30))):
        line = np.array([s for last in range(41) for s in [-1, *begun, last]])
        begin = np.arange(42) * (len(begun) + 2)
        prefix = log_probabilities(w, v, np.array([-1, *begun]), np.array([0, len(begun) + 1]))[0]
        assert abs(np.exp(log_probabilities(w, v, line, begin) - prefix).sum() - 1) < 1e-4


def test_each_symbol_is_scored_once_from_what_is_before_it(small):
    v, flat = small
    w = unpacked_weights(flat, v, 6)
    r = np.random.default_rng(5)
    texts = [np.append(r.integers(0, 40, n), v.end) for n in (0, 1, SPAN - 1, SPAN, SPAN + 1, 3 * SPAN + 5)]
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    symbols = np.concatenate([np.append(-1, t) for t in texts])
    text, at = windows(begin)
    assert sorted(p for t, a in zip(text, at) for p in range(a, min(a + SPAN, begin[t + 1]))) == [i for i, s in enumerate(symbols) if s >= 0]
    got = log_probabilities(w, v, symbols, begin)
    for k, t in enumerate(texts):
        want = 0.0
        for i, s in enumerate(t):
            first = i - i % SPAN - CONTEXT  # the window's first input
            x = np.array([w["E"][attention.START if j < 1 else v.row[t[j - 1]]] for j in range(first, i + 1)], np.float64)
            q = x[-1] @ w["Q"] / 6**0.5
            a = np.exp(x @ w["K"] @ q + w["D"][np.arange(len(x))[::-1]])
            h = np.tanh((a / a.sum()) @ (x @ w["V"]) @ w["A"] + x[-1] @ w["X"] + w["B"])
            soft = lambda z, j: z[j] - np.log(np.exp(z).sum())
            g = v.group[s]
            want += soft(h @ w["U"] + w["C"], g) + soft(h @ w["M"][g] + w["N"][g], v.member[s]) + v.share[s]
        assert abs(got[k] - want) < 1e-3 * max(1, abs(want))


def test_gradient_is_the_slope_of_the_loss(small):
    v, flat = small
    r = np.random.default_rng(6)
    flat = flat.astype(np.float64) + r.normal(0, 0.05, len(flat))
    rows = r.integers(0, v.row.max() + 1, (3, CONTEXT + SPAN))
    s = r.integers(0, 41, (3, SPAN))
    s[1, 5:] = -1
    group, member = np.where(s < 0, -1, v.group[s]), np.where(s < 0, -1, v.member[s])
    _, g = gradient(unpacked_weights(flat, v, 6), rows, group, member)
    found = np.concatenate([g[n].ravel() for n in unpacked_weights(flat, v, 6)])
    for i in r.choice(len(flat), 60, replace=False):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-4
        down[i] -= 1e-4
        slope = (gradient(unpacked_weights(up, v, 6), rows, group, member)[0] - gradient(unpacked_weights(down, v, 6), rows, group, member)[0]) / 2e-4
        assert abs(slope - found[i]) < 2e-3 * max(1, abs(slope))


def test_base_scores_match_plain_counts_and_training_helps(spark):
    r = random.Random(8)
    line = lambda n: " ".join("".join(r.choice(["ka", "lo", "mi"]) + r.choice(["ren", "tu"]) for _ in range(r.randint(1, 3))) for _ in range(n))
    rows = [(i, line(120), "en") for i in range(60)] + [(3, "Ka ka\tKALO", "en"), (3, "Ka ka\tKALO", "en"), (61, None, "en"), (62, "", None), (None, " \n", "en"), (63, "x" * 70_000 + " " + line(70_000), "en")]
    got = lm_scores(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [x for x in re.split("[\x20\x09-\x0d]+", (t or "").translate(LOWER)) if x] + [None]
    c = Counter(w for i, t, _ in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 4)) for i, t, _ in rows)
    assert sorted((str(g["doc_id"]), g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"], round(g["base_score"], 4)) for g in got) == want
    assert sum(held(i) for i, *_ in rows) > 3
    sums = [(g["score"], g["base_score"]) for g in got if g["held_out"] and g["n_tokens"] > 100]
    assert sum(a for a, _ in sums) > 1.5 * sum(b for _, b in sums)  # not far off words' own counts, which it doesn't know
    untrained = {str(g["doc_id"]): g["score"] for g in lm_scores(docs(spark, rows), rounds=0).collect()}
    assert all(g["score"] > untrained[str(g["doc_id"])] for g in got if g["held_out"] and g["n_tokens"] > 100)
    twice = [g["score"] for g in got if g["doc_id"] == 3 and g["n_tokens"] == 4]
    assert twice[0] == twice[1] and all(g["score"] < 0 for g in got)


def test_scores_of_tables_without_rows_or_training_texts(spark):
    assert lm_scores(docs(spark, [])).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = lm_scores(docs(spark, [(alone, "one two", "en")])).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 3, 0, 0, 0.0) and r["score"] < -5


@pytest.mark.parametrize("n", [40, 20_000])
def test_secrets_of_a_text_with_many_matches(spark, n):
    r = random.Random(n)
    parts, want = [], []
    for i in range(n):
        parts.append("é " * (i % 3) + "".join(r.choice("0123456789abcdef") for _ in range(32 + i % 5)))
        if i % 4 == 0:
            parts.append(f"password={r.randrange(10**9, 10**10)}{'ab' * (i % 2)}")
        if i % 7 == 0:  # a hex string within an assignment
            parts.append("token: " + "0f" * 20)
    text = " ".join(parts)
    for k, pattern in enumerate((r"(?:password|token)[:=] ?([A-Za-z0-9]{8,})", "[0-9a-f]{32,}")):
        want += [(m.start(), 2 * k, m.end()) for m in re.finditer(pattern, text)]
    want.sort()
    df = docs_table(spark, [(1, text, "en", "a", len(text)), (2, None, None, None, None), (3, "", "en", "a", 0)])
    got = {x["doc_id"]: x for x in secret_digests(df).collect()}
    assert got[1]["spans"] == ",".join(f"{('assign', '', 'hex')[k]}:{s}:{e}" for s, k, e in want)
    assert got[2]["spans"] == got[3]["spans"] == ""
    plain, at = [], 0
    for s, _, e in want:
        if s >= at:
            plain += [text[at:s], "[secret]"]
        at = max(at, e)
    texts = {x["doc_id"]: x["text"] for x in redacted(df).collect()}
    assert texts == {1: "".join(plain) + text[at:], 2: None, 3: ""}


def test_runs_outside_spans_match_all_pairs(spark):
    r = random.Random(8)
    rows = []
    for _ in range(300):
        spans = sorted((s, r.randrange(3), s + r.randint(1, 12)) for s in (r.randrange(60) for _ in range(r.randrange(6))))
        at, runs = 0, []
        while at < 60 and r.random() < 0.8:
            s = at + r.randrange(1, 9)
            at = s + r.randint(1, 9)
            runs.append((s, 3, at, "x"))
        rows.append((runs, spans))
    one = "array<struct<start:bigint,kind:int,end:bigint"
    df = spark.createDataFrame(rows, f"runs {one},match:string>>, spans {one}>>")
    for runs, spans, got in df.select("*", outside(F.col("runs"), F.col("spans"))).collect():
        assert [tuple(x) for x in got] == [tuple(x) for x in runs if not any(b["start"] < x["end"] and x["start"] < b["end"] for b in spans)]


def without_blanks(kind, n):
    r = random.Random(n)
    if kind == "one period":
        return "abc" * (n // 3)
    if kind == "one letter":
        return "a" * n
    if kind == "words":
        return "".join(r.choice(["the", "Data", "pipeline", "er", "tion", "über", "x"]) for _ in range(n // 4))
    return "".join(chr(r.randint(0x4E00, 0x9FFF)) if kind == "ideographs" else r.choice("etaoinshrdlu.é") for _ in range(n))


@pytest.mark.parametrize("kind", ["letters", "words", "ideographs", "one period", "one letter"])
def test_encoder_gives_the_library_s_ids_of_long_texts_without_blanks(kind):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=DEFAULT_MODEL)
    sizes = [100_000, 5_000, 700, 641, 640, 639, 513, 512, 511, 130, 40] if kind in ("letters", "words", "ideographs") else [20_000, 5_000, 600, 512]
    texts = [without_blanks(kind, n) for n in sizes] + ["a b " + without_blanks(kind, 900) + " c  d"]
    ids, begin = Encoder(Pieces.load(DEFAULT_MODEL)).encode(texts)
    for text, a, b in zip(texts, begin, begin[1:]):
        assert ids[a:b].tolist() == library.encode(text), len(text)
