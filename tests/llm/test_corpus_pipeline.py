from collections import Counter

import corpus_pipeline as cp
from tests.llm.brute import AWKWARD, SF_DIR, awkward, documents
from tests.llm.test_decontaminate import expected as contaminated
from tests.llm.test_poisson_mix import expected as repeated
from tests.llm.test_simhash_partitions import expected as grouped
from tidegate.llm import compress_quality, pii_boost, poisson_mix


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*cp.COLUMNS).collect()), key=str)


def test_each_stage_equals_brute_force_on_its_own_input(spark, tmp_path):
    docs = documents(spark)
    for name, stage in cp.STAGES:
        before = rows_of(docs)
        after = stage(spark, docs, SF_DIR)
        if name == "quality classifier":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            bad = {r.doc_id for r in compress_quality.classify(docs, labels).collect() if not r.predicted}
            want = [r for r in before if r[0] not in bad]
            assert bad
        elif name == "simhash near-dedup":
            first = {d for d, _, c in grouped([r[:2] for r in before]) if d == c}
            want = [r for r in before if r[0] in first]
        elif name == "benchmark decontamination":
            items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text")
            dirty = {r[0] for r in contaminated([r[:2] for r in before], [tuple(r) for r in items.collect()]) if r[5]}
            want = [r for r in before if r[0] not in dirty]
            assert dirty
        elif name == "personal data":
            selector = pii_boost.fit(docs)
            texts = [pii_boost.redacted(r[1], selector.spans(r[1])[1]) for r in before]
            want = [(r[0], t, r[2], r[3], len(t)) for r, t in zip(before, texts, strict=True)]
            assert not any(pii_boost.base_spans(t) for t in texts) and want != before
        else:
            rates = {r.source: r.rate for r in poisson_mix.source_rates(docs).collect()}
            times = repeated([(r[0], r[3]) for r in before], rates)
            want = [r for r in before for _ in range(times[r[0]])]
        if name != "source mixing":
            assert after.columns == cp.COLUMNS
        assert rows_of(after) == sorted(want, key=str)
        after.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert rows_of(cp.run(spark, SF_DIR)) == rows_of(docs)


def test_stages_take_awkward_rows(spark):
    for empty in (False, True):
        for _, stage in cp.STAGES:
            docs = awkward(spark, empty).selectExpr("*", "CAST(0 AS BIGINT) AS n_chars")
            assert len(stage(spark, docs, SF_DIR).collect()) <= (0 if empty else 40)


def test_one_of_each_group_stays_of_repeated_and_nameless_rows(spark):
    extra = [(None, "lone text of its own kind", "en", "a"), (None, "lone text of its own kind", "en", "a")]
    docs = spark.createDataFrame(AWKWARD + extra, "doc_id bigint, text string, lang string, source string")
    kept = cp.simhash_near_dedup(spark, docs.selectExpr("*", "CAST(0 AS BIGINT) AS n_chars"), SF_DIR).collect()
    names = Counter(r.doc_id for r in kept)
    assert names[1] == 1 and names[2] == 1 and names[3] == 0 and names[None] == 1
    assert [r.text for r in kept if r.doc_id is None] == ["lone text of its own kind"]


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    real = documents(spark)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = {r.doc_id: r.predicted for r in compress_quality.classify(real, labels).collect()}
    texts = {r.doc_id: r.text for r in real.collect()}
    bad, fine = (next(i for i, p in good.items() if p == want) for want in (0, 1))
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text")
    dirty = items.first().text + " " + items.first().text
    for name in (None, 10**9):
        pair = [(name, texts[bad], "en", "a", 1), (name, texts[fine], "en", "a", 1), (name, dirty, "en", "a", 1)]
        both = real.unionByName(spark.createDataFrame(pair, real.select(*cp.COLUMNS).schema))
        kept = [r.text for r in cp.quality_classifier(spark, both, SF_DIR).collect() if r.doc_id == name]
        assert texts[fine] in kept and texts[bad] not in kept
        kept = [r.text for r in cp.benchmark_decontamination(spark, both, SF_DIR).collect() if r.doc_id == name]
        assert texts[fine] in kept and dirty not in kept


def test_a_row_that_shares_a_leading_id_goes_with_its_own_group(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(0, one, "en", "a", 1), (1, one, "en", "a", 1), (1, two, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = cp.simhash_near_dedup(spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(0, one), (1, two)]
