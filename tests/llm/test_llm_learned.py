"""The learned operators and the fuzzy search against small plain versions, and the length of texts."""

import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest

from plainloom.llm import bpe, licenses, quality, rules, secrets, toxicity
from plainloom.session import ship, table

draw = random.Random(9)

# --- ordinal regression


@pytest.fixture
def graded(monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 12)
    rng = np.random.default_rng(1)
    rows = [rng.choice(12, size=rng.integers(0, 6), replace=False) for _ in range(50)]
    values = [rng.random(len(r)) for r in rows]
    return rows, values, rng.integers(0, 4, 50), rng.normal(0, 0.7, 12 + 3)


def plain_loss(rows, values, grades, param):
    """Row by row: P(grade <= k) is the logistic function of threshold k less the score."""
    cuts = [param[12]]
    for step in param[13:]:
        cuts.append(cuts[-1] + math.exp(step))
    total = 0.0
    for r, v, g in zip(rows, values, grades):
        score = sum(param[i] * x for i, x in zip(r, v))
        upto = [1 / (1 + math.exp(score - c)) for c in cuts] + [1.0]
        total -= math.log(upto[g] - (upto[g - 1] if g else 0.0))
    return total / len(rows) + quality.RIDGE / 2 * sum(w * w for w in param[:12])


def test_likelihood_and_gradient(graded):
    rows, values, grades, param = graded
    loss, gradient = quality.Likelihood(rows, values, grades).at(param)
    assert loss == pytest.approx(plain_loss(rows, values, grades, param), rel=1e-12)
    for i in range(len(param)):
        step = np.zeros(len(param))
        step[i] = 1e-6
        slope = (plain_loss(rows, values, grades, param + step) - plain_loss(rows, values, grades, param - step)) / 2e-6
        assert gradient[i] == pytest.approx(slope, abs=1e-6)


def test_fit_ends_near_the_least_loss(graded):
    rows, values, grades, _ = graded
    model = quality.fit_thresholds(rows, values, grades, rounds=2_000)
    assert list(model.thresholds) == sorted(model.thresholds)
    found = np.concatenate([model.weights, model.thresholds[:1], np.log(np.diff(model.thresholds))])
    least = plain_loss(rows, values, grades, found)
    rng = np.random.default_rng(2)
    assert all(plain_loss(rows, values, grades, found + rng.normal(0, s, len(found))) > least - 1e-6 for s in (0.01, 0.1, 1) for _ in range(40))


# --- toxicity


def plain_features(text, learned):
    words = text.lower().split()
    if not words:
        return [0.0] * len(toxicity.FEATURES)
    kinds = []
    for w in words:
        bare = w.strip(toxicity._EDGES)
        squeeze = lambda x: re.sub(r"(.)\1+", r"\1", x)
        listed = {squeeze(x) for x in toxicity.INSULTS} | {squeeze(x) for x in learned}
        kind = {k for k, of in (("stated", toxicity.INSULTS), ("learned", learned), ("second", toxicity.SECOND_PERSONS)) if bare in of}
        if not kind and len(bare) >= 4:
            signs = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
            shown = squeeze(re.sub(r"[.\-_*'’]", "", "".join(signs.get(c, c) for c in w).strip(toxicity._EDGES)))
            starred = "*" in bare and any(
                len(x) == len(bare) and 2 * bare.count("*") <= len(x) and all(a in ("*", b) for a, b in zip(bare, x)) for x in toxicity.INSULTS
            )
            if (shown != squeeze(bare) or squeeze(bare) != bare) and (shown in listed or squeeze(bare) in listed) or starred:
                kind = {"hidden"}
        kinds.append(kind)
    n = len(words)
    count = lambda k: sum(k in kind for kind in kinds)
    hit = [bool(k & {"stated", "learned", "hidden"}) for k in kinds]
    near = sum(hit[i] and any("second" in kinds[j] for j in range(max(0, i - 4), min(n, i + 5))) for i in range(n))
    capitals = sum("A" <= c <= "Z" for c in text)
    letters = sum(c.isascii() and c.isalpha() for c in text)
    shouted = sum("A" <= a <= "Z" and "A" <= b <= "Z" for a, b in zip(text, text[1:]))
    others = sum(c in ",.;:-\"'()#*$%&|<>" for c in text)
    return [
        count("stated") / n, count("learned") / n, math.log1p(count("stated")), math.log1p(count("learned")), near / n,
        count("second") / n, capitals / max(letters, 1), shouted / n, text.count("!") / n, text.count("?") / n, others / n,
        count("hidden") / n, math.log1p(count("hidden")),
    ]


def test_toxicity_features_equal_a_plain_version():
    learned = ["grobian", "blöder"]
    pool = ["you", "YOUR", "idiot", "id1ot,", "idiooot", "st*pid", "m.o.r.o.n", "grobian!", "gr0bian", "BLÖDER", "calm", "word", "É", "tu", "??", "$cum", "a-b", "***"]
    known = toxicity.Words(learned)
    for _ in range(400):
        text = draw.choice([" ", "\n", " \t"]).join(draw.choices(pool, k=draw.randint(0, 25)))
        assert toxicity.features_of(text, known) == pytest.approx(plain_features(text, learned)), text


def pooled(points):
    """Pool adjacent violators over (x, y), equal x first put together: blocks of [mean, weight, least x, largest x]."""
    by_x = {}
    for x, y in points:
        by_x.setdefault(x, []).append(y)
    blocks = []
    for x in sorted(by_x):
        blocks.append([sum(by_x[x]) / len(by_x[x]), len(by_x[x]), x, x])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, n, _, last = blocks.pop()
            b = blocks[-1]
            blocks[-1] = [(b[0] * b[1] + m * n) / (b[1] + n), b[1] + n, b[2], last]
    return blocks


def test_calibration_is_isotonic(spark):
    ship(spark)
    docs, labels = (table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = docs.join(labels.select("doc_id", "toxic"), "doc_id").where(toxicity.fold() == 4)
    found = toxicity._margins(model.trees, toxicity.with_features(rows, ["doc_id", "toxic"], model.lexicon)).collect()
    blocks = pooled([(r["margin"], r["toxic"]) for r in found])
    steps = list(model.calibrated.predictions)
    assert steps == sorted(steps)
    # Spark keeps the two ends of a block: there the calibrated score is the block's mean.
    at = dict(zip(model.calibrated.boundaries, steps))
    for mean, _, low, high in blocks:
        assert at[low] == pytest.approx(mean) and at[high] == pytest.approx(mean)


# --- labels


def test_several_and_null_labels(spark):
    ship(spark)
    rows = [(i, "good calm words here " * 9 if i % 2 else "bad shouted idiot YOU " * 9) for i in range(1, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    once = [(i, i % 2, 1 - i % 2) for i in range(1, 200)]
    more = [(i, None, None) for i in range(1, 40)] + [(None, 1, 0), (None, 0, 1), (10_000, 1, 1)]
    again = [(i, 1, 0) for i in range(1, 200, 2)]  # the same label twice
    tables = [spark.createDataFrame(r, "doc_id long, quality int, toxic int") for r in (once, once + more + again)]
    first, second = (quality.fit(docs, quality.grades_of(t)) for t in tables)
    assert first.thresholds == pytest.approx(second.thresholds) and first.weights == pytest.approx(second.weights)
    assert rules.fit(docs, tables[0]) == rules.fit(docs, tables[1])
    scores = [{r["doc_id"]: r["score"] for r in toxicity.fit(docs, t).score(docs).collect()} for t in tables]
    assert scores[0] == pytest.approx(scores[1])
    # Of different labels of a document the worse one counts.
    both = spark.createDataFrame(once + [(i, 0, 1) for i in range(1, 200)], "doc_id long, quality int, toxic int")
    assert rules.fit(docs, both) == [] or all(rules.fit(docs, both))
    assert {r["score"] for r in toxicity.fit(docs, both).score(docs).collect()} == {1.0}
    assert quality.fit(docs, quality.grades_of(both)) is None


# --- decision lists


def test_first_condition_has_the_greatest_gain():
    rng = np.random.default_rng(4)
    feature = {"a": rng.integers(0, 9, 300).astype(float), "b": rng.integers(0, 5, 300).astype(float)}
    bad = (feature["a"] > 5) ^ (rng.random(300) < 0.1)
    (first, *_) = rules._grow(feature, bad, 4, 24)

    def gain(mask):
        p, n = bad[mask].sum(), mask.sum()
        return p * (math.log2(p / n) - math.log2(bad.mean())) if p and n < 300 else 0.0

    every = [gain(rules.Condition(f, above, t + 0.5).mask(feature)) for f in feature for above in (False, True) for t in range(9)]
    assert gain(first.mask(feature)) == pytest.approx(max(every))


def test_lists_and_expressions_agree(spark):
    rng = np.random.default_rng(6)
    rows = rng.integers(0, 6, (200, 2)).astype(float)
    listed = [[rules.Condition("a", True, 3.5), rules.Condition("b", False, 2.0)], [rules.Condition("b", True, 4.5)]]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rows)], "i int, a double, b double")
    got = {r["i"]: r["ok"] for r in df.select("i", rules.verdict(listed).alias("ok")).collect()}
    feature = {"a": rows[:, 0], "b": rows[:, 1]}
    rejected = rules._covers(listed[0], feature) | rules._covers(listed[1], feature)
    assert [got[i] for i in range(200)] == (~rejected).tolist()


# --- licence notices


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def ends_near(text, notice, k):
    """Ends of the stretches of a text within k edits of a notice."""
    row, out = list(range(len(notice) + 1)), set()
    for i, x in enumerate(text, 1):
        before, row = row, [0]
        for j, y in enumerate(notice, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        if row[-1] <= k:
            out.add(i)
    return out


def test_notices_are_within_their_edits_and_none_is_lost():
    notices = list(licenses.NOTICES)
    for _ in range(60):
        parts = []
        for _ in range(draw.randint(1, 4)):
            notice = list(draw.choice(notices))
            for _ in range(draw.randint(0, licenses.edits_allowed("".join(notice)) + 2)):
                at = draw.randrange(len(notice))
                notice[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "q "])
            parts += ["".join(notice), " ".join(draw.choices(["some", "other", "é", "text"], k=draw.randint(0, 4)))]
        text = licenses.normal_form(" ".join(parts))
        found = licenses.fuzzy_notices(text)
        for (a, b, notice, edits), after in zip(found, [*found[1:], (len(text) + 1,)]):
            assert distance(text[a:b], notice) <= edits <= licenses.edits_allowed(notice) and b <= after[0]
        for notice in notices:
            for end in ends_near(text, notice, licenses.edits_allowed(notice)):
                assert any(a < end and end - len(notice) - 20 < b for a, b, *_ in found), (text, notice, end)


@pytest.mark.parametrize("first", ["released under teh mit licese", "all rihts reserved"])
def test_a_better_notice_further_on_hides_none(first):
    exact = {"r": "released under the mit license", "a": "all rights reserved"}[first[0]]
    row = licenses.scan_text(f"É: {first.upper()} xx {exact}")
    assert [(s["start"], s["end"]) for s in row[-1]] == [(3, 3 + len(first)), (7 + len(first), 7 + len(first) + len(exact))]


# --- own rules, long texts


def test_own_rules(spark):
    own = (secrets.Rule("pin", r"PIN ([0-9]+)", 1, 4), secrets.Rule("digits", r"[0-9]{3,}"))
    docs = spark.createDataFrame([(1, "é PIN 12 PIN 12345 999"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r["spans"] for r in secrets.with_spans(docs, "spans", own).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in rows[1]] == [("pin", 9, 18), ("digits", 13, 18), ("digits", 19, 22)]
    assert rows[2] == []
    with pytest.raises(ValueError):
        secrets.with_spans(docs, "spans", own * 32)


def test_long_texts_take_seconds(spark):
    began = time.time()
    many = 50_000
    docs = spark.createDataFrame([(1, "é token=abcdef12 " * many), (2, "x" * 1_000_000)], "doc_id long, text string")
    row = {r["doc_id"]: r for r in secrets.scan(docs).collect()}
    assert row[1]["n_assign"] == many and row[1]["spans"].endswith(f"assign:{17 * many - 15}:{17 * many - 1}")
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert clean == {1: "é [secret] " * many, 2: "x" * 1_000_000}
    merges = bpe.load(open(public_tokenizers.path("word_bpe_49k.json")).read())
    for text in ("a!" * 500_000, "x" * 1_000_000):
        assert merges.decode(merges.encode(text)).replace(b" ", b"").replace(b"</w>", b"") == text.encode()
    places = licenses.scan_text("the mit license " * 50_000)
    assert places[1] == 50_000 and places[3] == 3 * 49_999 + 1
    assert len(licenses.scan_text("all rihts reserved " * 20_000)[-1]) == 20_000
    for text in ("idiot! " * 150_000, "x" * 1_000_000, "-" * 1_000_000):
        rules.statistics_of(text)
        toxicity.features_of(text, toxicity.Words([]))
    assert time.time() - began < 120
