import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.brute import AWKWARD, SF_DIR, awkward, documents, words
from tidegate.llm import rule_thresholds as rt


def counts(text):
    text = text or ""
    tokens = words(text)
    grams = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(tokens),
        sum(map(len, tokens)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def check_counts(df, rows):
    got = sorted((tuple(r[c] for c in ["doc_id", *COUNTS, "base_failed"]) for r in df.collect()), key=str)
    want = []
    for doc_id, text in rows:
        c = counts(text)
        want.append((doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(want, key=str)


def labels(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_whole_table(spark):
    docs = documents(spark)
    judged = rt.judge(docs, labels(spark))
    check_counts(judged, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_awkward_rows(spark):
    check_counts(rt.judge(awkward(spark), labels(spark)), [row[:2] for row in AWKWARD])
    assert rt.judge(awkward(spark, empty=True), labels(spark)).collect() == []
    none = rt.judge(awkward(spark), labels(spark).limit(0)).collect()
    assert all(r.kept is not r.base_failed for r in none)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b#é!", max_size=60), min_size=1, max_size=8))
def test_counts_of_any_text(spark, texts):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id bigint, text string, lang string")
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in rt.text_counts(docs).collect()}
    assert got == {i: counts(t) for i, t in rows}


def binomial(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_the_binomial_is_exact(spark):
    cases = [(k, n, p) for n in (0, 1, 10, 500) for k in (0, 1, 3, 7) for p in (0.01, 0.02, 0.3) if 0 < k <= n * p or k == 0]
    for p in (0.01, 0.02, 0.3):
        mine = [(k, n) for k, n, q in cases if q == p]
        df = spark.createDataFrame(mine, "k bigint, n bigint")
        for r in df.select("k", "n", rt.at_most(F.col("k"), F.col("n"), p).alias("p")).collect():
            assert r.p == pytest.approx(binomial(r.k, r.n, p), rel=1e-9)
    large = spark.createDataFrame([(900, 100_000)], "k bigint, n bigint")
    p = large.select(rt.at_most(F.col("k"), F.col("n"), 0.01)).first()[0]
    assert p == pytest.approx(binomial_log(900, 100_000, 0.01), rel=1e-6)


def plain_statistics(text):
    c, text = counts(text), text or ""
    lines = sum(bool(words(x)) for x in text.split("\n"))
    per = lambda x, n: x / n if n else 0.0
    return {
        "symbols_per_word": per(c[2], c[0]),
        "repeated_share": per(c[4], c[0]),
        "duplicate_line_share": per(c[3], lines),
        "exclamations_per_word": per(text.count("!"), c[0]),
        "chars_per_word": per(c[1], c[0]),
    }


def plain_cutoffs(rows, quality):
    """{lang: {rule: cutoff}} from (doc_id, text, lang) rows and {doc_id: quality}."""
    said = {}
    for doc_id, text, lang in rows:
        if quality.get(doc_id) is not None:
            said.setdefault((lang, text or ""), []).append(quality[doc_id])
    good = {}
    for (lang, text), marks in said.items():
        if min(marks) == 1:
            good.setdefault(lang, []).append(plain_statistics(text))
    cuts = {}
    for lang, stats in good.items():
        loose = {r: sorted(grid, reverse=True) for r, grid in rt.RULES.items()}
        n, chosen = len(stats), dict.fromkeys(rt.RULES)
        for i in range(max(map(len, loose.values()))):
            at = {r: grid[min(i, len(grid) - 1)] for r, grid in loose.items()}
            any_ = sum(any(x[r] > c for r, c in at.items()) for x in stats)
            if binomial_log(any_, n, rt.RISK) > rt.ALPHA / len(good):
                break
            for r, c in at.items():
                if sum(x[r] > c for x in stats) * len(rt.RULES) <= n * rt.RISK:
                    chosen[r] = c
        cuts[lang] = chosen
    return cuts


def plain_kept(text, cuts):
    c = counts(text)
    if c[0] < 50 or 100 * c[4] > 50 * c[0]:
        return False
    stats = plain_statistics(text)
    return not any(cut is not None and stats[r] > cut for r, cut in cuts.items())


@pytest.mark.parametrize("sf, languages", [("sf0.01", 1), ("sf0.1", 4)])
def test_kept_equals_brute_force(spark, sf, languages):
    docs, known = documents(spark, f"/root/testdata/{sf}"), labels(spark, f"/root/testdata/{sf}")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    quality = {r.doc_id: r.quality for r in known.collect()}
    cuts = plain_cutoffs(rows, quality)
    assert sum(any(c is not None for c in mine.values()) for mine in cuts.values()) == languages
    got = {r.doc_id: (r.kept, r.base_failed) for r in rt.judge(docs, known).collect()}
    assert {d: k for d, (k, _) in got.items()} == {d: plain_kept(t, cuts.get(lang, {})) for d, t, lang in rows}
    assert any(not kept and not failed for kept, failed in got.values())  # the method has a say
    good = [d for d, _, _ in rows if quality.get(d) == 1 and not got[d][1]]
    bad = [d for d, _, _ in rows if quality.get(d) == 0]
    assert sum(not got[d][0] for d in good) / len(good) < rt.RISK
    assert sum(not got[d][0] for d in bad) / len(bad) > 0.5


def test_copies_of_a_text_change_no_cutoff(spark):
    docs, known = documents(spark).select("doc_id", "text", "lang"), labels(spark).select("doc_id", "quality")

    def cutoffs(d, k):
        return sorted(map(tuple, rt.thresholds(rt.statistics(rt.text_counts(d)), k).collect()), key=str)

    ids = F.sequence(F.lit(10**9).cast("long"), F.lit(10**9 + 2_999).cast("long"))
    text = " ".join(f"wort{i}" for i in range(60))
    few = spark.range(1).select(F.explode(ids).alias("doc_id"), F.lit(text).alias("text"), F.lit("de").alias("lang"))
    marked = few.select("doc_id", F.lit(1).cast("int").alias("quality"))
    plain = cutoffs(docs, known)
    assert any(c is not None for row in plain for c in row[1:])
    one = few.where(F.col("doc_id") == 10**9)
    assert cutoffs(docs.union(few), known.union(marked)) == cutoffs(docs.union(one), known.union(marked))
    alone = cutoffs(few, marked)
    assert [row[1:] for row in alone] == [(None,) * len(rt.RULES)]  # 3,000 copies are one trial


def binomial_log(k, n, p):
    if k > n * p:
        return 1.0
    return sum(
        math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
        for i in range(k + 1)
    )
