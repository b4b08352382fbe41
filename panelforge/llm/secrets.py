"""Secret scans: fixed patterns, and runs of characters that look random.

The three fixed kinds are found by pattern. Beyond them every unbroken run of `least` or more
characters of the base64 alphabet is a candidate. Its encoding is inferred from its characters (hex,
base32, base64), and a battery of tests asks whether it can be a random string of that encoding:
chi-squared uniformity over the alphabet, runs above and below the alphabet's middle, and serial
correlation. Every run is then weighed against ordinary text: the ratio of
its probability under a random string to that under the character frequencies of runs that a test
rejects at `alpha`, each run weighing the same, blended with those of English letters. Such a ratio is an e-value: for
ordinary text its mean is at most 1, and it grows with the run's length. Each test multiplies it by
p / alpha where that is less than 1, so the battery's p-values (upper bounds of them, exp(-z * z / 2))
enter with the length, and what remains is an e-value still. Benjamini and Hochberg's procedure on
these over all candidates of the corpus keeps the false discovery rate below `rate`, whatever the dependence between them.
DataFrame functions only.

Defined results: a null text is empty and has no spans; offsets are code points, end exclusive;
in a table without rejected runs the prior of English letters alone stands for ordinary text;
repeated rows are candidates of their own and get equal spans; very long texts are scanned whole, and the time for
one grows with its matches to the power of 1.5, with a small factor; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import blocks, let, running, staged

#: Kind, pattern of one match, shortest match (of group 2 where there is one), cheap test.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
#: Order of characters in the alphabets; an encoding's characters are a slice of its string.
HEX_SET, B32_SET, B64_SET = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Characters of ordinary runs before any is seen: letters as in English (per 10,000), others as rare as in prose; and its weight in runs.
ENGLISH = dict(zip("abcdefghijklmnopqrstuvwxyz", (817, 149, 278, 425, 1270, 223, 202, 609, 697, 15, 77, 403, 241, 675, 751, 193, 10, 599, 633, 906, 276, 98, 236, 15, 197, 7)))
PRIOR = {c: 0.92 * ENGLISH[c] / sum(ENGLISH.values()) if c in ENGLISH else 0.04 / 26 if c.isupper() else 0.03 / 10 if c.isdigit() else 0.005 for c in B64_SET}
PRIOR_RUNS = 16.0
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as structs of start, kind and end.

    The pieces between the matches come from `split`, so running sums of lengths give offsets.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)
    sizes = F.filter(F.zip_with(found, F.transform(gaps, lambda g: F.length(g)), lambda m, g: F.struct(g.cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("size"), m.alias("match"))), lambda x: x["match"].isNotNull())
    ends = lambda xs: running(F.transform(xs, lambda x: x["gap"] + x["size"]), lambda a, n: a + n)
    return let(sizes, lambda xs: F.zip_with(xs, ends(xs), lambda x, e: F.struct((e - x["size"]).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), x["match"].alias("match"))))


def outside(runs: Column, spans: Column) -> Column:
    """The runs that no span overlaps, by a sweep: the farthest end of the spans that begin before a run's end."""
    event = lambda at, kind, end, run: F.struct(at.alias("at"), F.lit(kind).alias("kind"), end.alias("end"), run.alias("run"))
    begun = F.transform(spans, lambda x: event(x["start"], 1, x["end"], F.lit(-1)))
    met = F.transform(runs, lambda x, i: event(x["end"], 0, F.lit(0).cast("bigint"), i))  # before a span that begins at its end
    events = F.array_sort(F.concat(begun, met))
    farthest = lambda es: running(F.transform(es, lambda e: e["end"]), lambda a, x: F.greatest(a, x))
    pairs = let(events, lambda es: F.zip_with(es, farthest(es), lambda e, far: F.struct(e["run"].alias("run"), far.alias("far"))))
    free = F.filter(F.transform(F.filter(pairs, lambda e: e["run"] >= 0), lambda e: F.struct(F.get(runs, e["run"]).alias("run"), e["far"].alias("far"))), lambda e: e["far"] <= e["run"]["start"])
    return F.when(F.size(spans) == 0, runs).otherwise(F.transform(free, lambda e: e["run"]))


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds. A cheap test spares most texts the slow patterns."""
    none = F.array().cast(SPAN)
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2))
    assign = F.when(text.rlike(r"[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}"), _bare(F.filter(matches(text, ASSIGN, 0), lambda x: value(x["match"]) >= 8))).otherwise(none)
    access = F.when(text.contains("AKIA"), _bare(matches(text, ACCESS, 1))).otherwise(none)
    hexes = F.when(text.rlike(HEX), _bare(matches(text, HEX, 2))).otherwise(none)
    return F.array_sort(F.concat(assign, access, hexes))


def spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _tail(z: Column) -> Column:
    """Logarithm of a bound of the two-sided normal tail beyond |z|: exp(-z*z/2)."""
    return -z * z / 2


def battery(run: Column) -> Column:
    """Encoding, length, and the logarithms of the p-values of the three tests of one run, as a struct.

    Symbols are numbered by their place in the alphabet; url-safe characters count as their twins.
    """
    coding = F.when(run.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 0).when(run.rlike("^[A-Z2-7]+=*$"), 1).otherwise(2)
    plain = F.regexp_replace(F.translate(run, "-_", "+/"), "=+$", "")
    plain = F.when(coding == 0, F.lower(plain)).otherwise(plain)
    alphabet = F.when(coding == 0, HEX_SET).when(coding == 1, B32_SET).otherwise(B64_SET)
    size = F.when(coding == 0, 16.0).when(coding == 1, 32.0).otherwise(64.0)

    def tests(b: Column) -> Column:
        s, k, n = b["symbols"], b["size"], F.size(b["symbols"]).cast("double")
        counts = F.transform(F.array_distinct(s), lambda v: F.size(F.filter(s, lambda x: x == v)).cast("double"))
        chi2 = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) * k / n - n
        # with few symbols per cell the statistic is normal with mean k-1 and variance 2(k-1)(1-1/n)
        z_chi = (chi2 - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
        mid = (k - 1) / 2
        high = F.transform(s, lambda x: (x > mid).cast("int"))
        n1 = F.aggregate(high, F.lit(0.0), lambda a, x: a + x)
        n2 = n - n1
        runs = let(high, lambda h: F.aggregate(F.zip_with(h, F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))), lambda x, y: F.coalesce((x != y).cast("double"), F.lit(0.0))), F.lit(1.0), lambda a, x: a + x))
        mean = 2 * n1 * n2 / n + 1
        var = F.greatest(F.lit(1e-9), (mean - 1) * (mean - 2) / (n - 1))
        z_runs = F.when((n1 == 0) | (n2 == 0), 9.0).otherwise((runs - mean) / F.sqrt(var))
        pairs = F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), lambda x, y: F.coalesce((x - mid) * (y - mid), F.lit(0.0)))
        spread = F.aggregate(s, F.lit(0.0), lambda a, x: a + (x - mid) * (x - mid))
        z_serial = F.when(spread > 0, F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / spread * F.sqrt(n)).otherwise(9.0)
        return F.struct(b["coding"].alias("coding"), b["plain"].alias("plain"), n.alias("n"), _tail(F.greatest(z_chi, F.lit(0.0))).alias("p_chi"), _tail(z_runs).alias("p_runs"), _tail(z_serial).alias("p_serial"))

    bound = F.struct(coding.alias("coding"), plain.alias("plain"), alphabet.alias("alphabet"), size.alias("size"))
    place = lambda a, c: (F.call_function("locate", c, a["alphabet"]) - 1).cast("double")
    full = let(bound, lambda a: F.struct(a["coding"].alias("coding"), a["plain"].alias("plain"), a["size"].alias("size"), F.transform(F.filter(F.split(a["plain"], ""), lambda c: c != ""), lambda c: place(a, c)).alias("symbols")))
    return let(full, tests)


def candidate_runs(text: Column, least: int) -> Column:
    return F.when(text.rlike(f"[A-Za-z0-9+/_=-]{{{least}}}"), matches(text, f"[A-Za-z0-9+/_=-]{{{least},}}", 3)).otherwise(F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string>>"))


def _frequencies(rejected: DataFrame) -> DataFrame:
    """Log probabilities of characters in ordinary runs, one row: a map.

    The mean of the runs' own frequencies, so that no run weighs more for its length, with PRIOR
    as PRIOR_RUNS runs more.
    """
    size = F.length("plain")
    share = lambda c: (size - F.length(F.replace(F.col("plain"), F.lit(c), F.lit("")))) / size
    sums = rejected.filter(size > 0).agg(F.count("*").alias("n"), *[F.sum(share(c)).alias(f"_{i}") for i, c in enumerate(B64_SET)])
    entry = lambda i, c: F.struct(F.lit(c), F.log((F.coalesce(F.col(f"_{i}"), F.lit(0.0)) + PRIOR_RUNS * PRIOR[c]) / (F.col("n") + PRIOR_RUNS)))
    return sums.select(F.map_from_entries(F.array(*[entry(i, c) for i, c in enumerate(B64_SET)])).alias("_logs"))


def random_runs(spans: DataFrame, alpha: float, rate: float, step: float = 0.25, top: float = 400.0) -> DataFrame:
    """spans: _uid, run (start, kind, end, match). Returns _uid, start, end of the runs taken for secrets."""
    tested = staged(spans.withColumn("_b", battery(F.col("run.match"))).select("_uid", "run.start", "run.end", "_b.*"), "secret-runs")
    against = [F.least(F.lit(0.0), F.col(p) - math.log(alpha)) for p in ("p_chi", "p_runs", "p_serial")]
    battered = against[0] + against[1] + against[2]
    logs = F.broadcast(_frequencies(tested.filter(battered < 0)))  # one row of 64 numbers
    scored = tested.select("*", F.lit(1).alias("_one")).join(logs.withColumn("_one", F.lit(1)), "_one")
    ordinary = F.aggregate(F.filter(F.split("plain", ""), lambda c: c != ""), F.lit(0.0), lambda a, c: a + F.element_at("_logs", c))
    size = F.when(F.col("coding") == 0, 16.0).when(F.col("coding") == 1, 32.0).otherwise(64.0)
    scored = scored.select("_uid", "start", "end", F.greatest(F.lit(0.0), F.least(F.lit(top), -F.col("n") * F.log(size) - ordinary + battered)).alias("_log_e"))
    scored = scored.withColumn("_bin", F.floor(F.col("_log_e") / step))
    # the step-up threshold: the lowest bin b with exp(b * step) >= candidates / (rate * runs at or above b)
    total = tested.groupBy().agg(F.count("*").alias("_m"))
    bins = scored.groupBy("_bin").agg(F.count("*").alias("_n"))  # top / step rows at most
    above = bins.withColumn("_k", F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy(F.col("_bin").desc()))).withColumn("_one", F.lit(1))
    good = above.join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one").filter(F.col("_bin") * step >= F.log(F.col("_m") / (rate * F.col("_k"))))
    least = good.groupBy("_one").agg(F.min("_bin").alias("_least"))
    return scored.withColumn("_one", F.lit(1)).join(F.broadcast(least), "_one").filter("_bin >= _least").select("_uid", "start", "end")


def secret_spans(docs: DataFrame, keep: list[str], least: int = 20, alpha: float = 1e-3, rate: float = 1e-3) -> DataFrame:
    """The `keep` columns of every row as a struct `_row`, and its _base and _all spans in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), base_spans(text).alias("_base"), candidate_runs(text, least).alias("_runs"))
    found = found.select("_row", "_base", let(F.col("_runs"), lambda r: let(F.col("_base"), lambda b: outside(r, b))).alias("_runs"))
    found = staged(found.select("*", (F.size("_runs") > 0).alias("_any"), F.monotonically_increasing_id().alias("_uid")), "secret-spans")
    added = random_runs(found.select("_uid", F.explode("_runs").alias("run")), alpha, rate).groupBy("_uid").agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end")).alias("_added"))
    # texts without a run outside the base spans stay where they are
    whole = found.filter("not _any").select("_row", "_base", F.col("_base").alias("_all"))
    out = found.filter("_any").join(added.hint("merge"), "_uid", "left")  # grows with the corpus
    return whole.unionByName(out.select("_row", "_base", F.array_sort(F.concat("_base", F.coalesce("_added", F.array().cast(SPAN)))).alias("_all")))


def secret_digests(docs: DataFrame, **options) -> DataFrame:
    count = lambda k: F.size(F.filter("_base", lambda x: x["kind"] == k)).cast("long")
    s = secret_spans(docs, ["doc_id"], **options)
    return s.select(
        "_row.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spelled(F.col("_base")), 256).alias("base_sha256"), spelled(F.col("_all")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]", **options) -> DataFrame:
    """`docs` with every span of `text` replaced by `mark`; n_chars follows, if there is one."""
    s = secret_spans(docs, docs.columns, **options)
    whole = F.col("_row.text")
    part = lambda t, at, end: F.substring(t, (at + 1).cast("int"), (end - at).cast("int"))
    # a span that begins within the spans before it lengthens their mark; the others end a piece of text
    piece = lambda ends: F.transform("_all", lambda x, i: F.struct(F.coalesce(F.get(ends, i - 1), F.lit(0).cast("bigint")).alias("at"), x["start"].alias("end")))
    marked = lambda b, t: F.array_join(F.transform(b, lambda x: F.concat(part(t, x["at"] - b[0]["at"], x["end"] - b[0]["at"]), F.lit(mark))), "")
    # slices of the pieces are cut out of the text, then each slice into its pieces: places in a text are found by walking it
    cut = lambda ends: F.array_join(F.transform(blocks(F.filter(piece(ends), lambda x: x["end"] >= x["at"])), lambda b: let(part(whole, b[0]["at"], F.element_at(b, -1)["end"]), lambda t: marked(b, t))), "")
    farthest = running(F.transform("_all", lambda x: x["end"]), lambda a, x: F.greatest(a, x))
    changed = let(farthest, lambda ends: F.concat(cut(ends), F.substring(whole, (F.element_at(ends, -1) + 1).cast("int"), F.lit(2**31 - 1))))
    text = F.when(F.size("_all") == 0, whole).otherwise(changed)
    out = s.withColumn("_text", text)
    special = {"text": F.col("_text"), "n_chars": F.when(F.size("_all") == 0, F.col("_row.n_chars")).otherwise(F.length("_text").cast("long")) if "n_chars" in docs.columns else None}
    return out.select(*[(special[c] if c in special else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
