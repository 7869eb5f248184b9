"""Each operator against brute force, a round trip or held-out accuracy, and on odd inputs."""

import hashlib
import math
import re
import time
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.compare import compare, duck
from tests.conftest import SF01
from tierlake.llm import decontaminate, language_id, mixing, near_dedup, pii, quality_rules, suffix_dedup, token_counts, toxicity, warc_bundles
from tierlake.sources.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, c0 int"
LONG = " ".join(f"word{i % 977} and" for i in range(40_000))
ROWS = [
    (1, None, None, None, None, "x", 1), (2, "", "en", "a", 0, None, 2), (3, " \t\n ", "en", "a", 4, "y", 3),
    (4, "one two", "en", None, 7, "y", 4), (5, "ONE two", None, "a", 7, "y", 5), (6, LONG, "en", "b", len(LONG), "y", 6),
    (7, LONG, "en", "b", len(LONG), "y", 7), (7, LONG, "en", "b", len(LONG), "y", 7), (8, "é😀 日本語 +1 (212) 555-0100 me@x.org 1.2.3.4", "de", "a", 40, "y", 8),
    (None, "no id here", "en", "a", 10, "z", 9), (9, "123456 !!! ###", "en", "a", 14, "z", 9),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF01, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_sql_oracles(spark):
    con = duck(SF01)
    for name, sql in E.LLM_SQL.items():
        assert compare(E.LLM_QUERIES[name](spark, SF01), con, sql) == []


# --- quality rules ---


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {i + j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


def test_quality_counts_and_verdicts(spark, docs, texts):
    got = by_id(quality_rules.score(docs))
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF01, "labels").collect()}
    for i, text in texts:
        c = counts(text)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        assert tuple(got[i][k] for k in quality_rules.COUNTS) == c and got[i]["base_failed"] == failed
        assert not (failed and got[i]["kept"])
    good = [got[i]["kept"] for i, q in labels.items() if q == 1 and not got[i]["base_failed"]]
    bad = [got[i]["kept"] for i, q in labels.items() if q == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.3


def test_quality_odd_rows(odd, none):
    got = quality_rules.score(odd).collect()
    assert len(got) == len(ROWS) and all(r["base_failed"] for r in got if r["n_words"] < 20)
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and quality_rules.keep_good(none).count() == 0
    assert quality_rules.score(none).count() == 0


def prose(rng, n):
    words = ["".join(rng.choice(list("abcdeghilmnorstu"), int(rng.integers(2, 10)))) for _ in range(n)]
    return " ".join(w.capitalize() if i % 11 == 0 else w + "." if i % 11 == 10 else w for i, w in enumerate(words))


def test_quality_judges_small_groups(spark):
    rng = np.random.default_rng(5)
    rows = [(prose(rng, 120), lang, source, "good") for lang, source, n in (("en", "big", 500), ("en", "tiny", 30), ("xx", "rare", 30)) for _ in range(n)]
    rows += [(prose(rng, 60).replace(" ", " | "), lang, source, "junk") for lang, source in (("en", "tiny"), ("xx", "rare")) for _ in range(2)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, label string")
    for part in (docs, docs.where("lang = 'xx'")):  # a table with large groups, and one of few rows
        n = Counter(r["label"] for r in part.select("label").collect())
        kept = Counter(r["label"] for r in quality_rules.keep_good(part).collect())
        assert kept["junk"] == 0 and kept["good"] > 0.97 * n["good"]
        assert quality_rules.score(part).where("outlier_d2 is null").count() == 0


def test_quality_rejects_moderate_junk(spark):
    rng = np.random.default_rng(6)
    rows = [prose(rng, 120) for _ in range(300)]
    rows.append(" ".join(w for w in prose(rng, 60).split() for _ in range(2)))  # every word twice
    rows.append("\n".join(["one short line"] * 2 + [f"{w} x" for w in prose(rng, 9).split()] + ["again so"] * 40))
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = by_id(quality_rules.score(docs))
    assert not got[300]["base_failed"] and not got[300]["kept"] and not got[301]["kept"]
    assert sum(got[i]["kept"] for i in range(300)) > 294


def test_chi_square():
    assert quality_rules.chi2_quantile(0.975, 2) == pytest.approx(-2 * math.log(0.025))
    assert quality_rules.consistency(1 - 1e-12, 3) == pytest.approx(1, abs=1e-6)


# --- near duplicates ---


def brute_groups(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = defaultdict(list)
    for i in sorted(sets):
        for c in {c for s in sets[i] for c in held[s]}:
            n = len(sets[i] & sets[c])
            if 100 * n >= percent * (len(sets[i]) + len(sets[c]) - n):
                a, b = find(i), find(c)
                root[max(a, b)] = min(a, b)
        for s in sets[i]:
            held[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(docs, texts, k, percent):
    got = by_id(near_dedup.near_duplicates(docs, k, percent))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_groups(texts, k, percent)


def test_near_duplicates_dense_bucket(spark):
    """Edited copies of one text that are not all alike: chains and several components in a bucket."""
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i % 30] + [f"x{i // 30}"] + base[i % 30 + 1:])) for i in range(90)]
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_groups(rows, 3, 85)


def test_near_duplicates_odd_rows(odd, none):
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(odd).collect()}
    assert got[1, 0] == (1, True) and got[5, 1] == (4, False) and got[None, 1] == (None, True)
    assert {k[0]: v for k, v in got.items()}[7] == (6, False)
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8, 9]
    assert near_dedup.near_duplicates(none).count() == 0


def test_sketch_fills_and_estimates():
    a = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sets = [a[:800], a[100:900], a[:1]]
    who = np.repeat([0, 1, 2], [len(s) for s in sets])
    s = near_dedup.sketch(who, np.concatenate(sets), 3, 256)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert (s[0] == s[1]).mean() == pytest.approx(700 / 900, abs=0.12)


# --- decontamination ---


def test_leaks(spark, docs, texts, odd, none):
    benchmark = table(spark, SF01, "benchmark")
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()}
    exact = {(i, j) for i, t in texts for j, b in items.items() if t and b in t}
    assert found >= exact and len(found - exact) <= 0.05 * len(exact)
    assert decontaminate.drop_leaks(docs, benchmark).count() == docs.count() - len({i for i, _ in found})
    edited = items[0].split()
    edited = " ".join(w if i % 7 else "changed" for i, w in enumerate(edited))
    extra = spark.createDataFrame([(1, f"before it {edited} after it"), (2, "quite another text")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(extra, benchmark).collect()} == {(1, 0)}
    assert decontaminate.drop_leaks(odd, benchmark).count() == len(ROWS)
    assert decontaminate.leaks(none, benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.where("false")).count() == 0


def test_leaks_of_edited_copies_of_a_hot_short_item(spark):
    rng = np.random.default_rng(7)
    item = [f"w{i}" for i in range(15)]
    rows = []
    for i in range(400):
        text = [f"x{j}" for j in rng.integers(0, 3000, 60)]
        if i < 200:  # three of 15 words changed: some three neighbours are always left
            cut = set(rng.choice(15, 3, replace=False).tolist())
            text[30:30] = [f"y{j}" if j in cut else w for j, w in enumerate(item)]
        rows.append((i, " ".join(text)))
    benchmark = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in decontaminate.leaks(docs, benchmark).collect() if r["score"] >= 0.5} >= set(range(200))
    assert decontaminate.drop_leaks(docs, benchmark).count() == 200


def test_alignment_equals_full_matrix():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(1, 5, rng.integers(1, 9)), rng.integers(1, 5, rng.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontaminate.align(a, b)[0] == h.max()


# --- personal data ---


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        luhn = sum((v - 9 if v > 9 else v) for v in (int(c) * (1 + i % 2) for i, c in enumerate(d[::-1])))
        if 12 <= len(d) <= 19 and luhn % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def text_of(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_pii_base_and_more(spark, texts, docs):
    tricky = ["a@b.c._x@y.z", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255", "+1 (269) 555-3296 4524132264652876", "9" * 5000,
              "x" * 3000 + "@", "4 5 2 4-1322 6465 2876 é 4111111111111111", "😀 me@a-b.co.uk +49 30 1234567", ""]
    rows = texts + [(10 ** 6 + i, t) for i, t in enumerate(tricky)]
    got = by_id(pii.spans(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, t in rows:
        want = text_of(base_spans(t or ""))
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (i, want, got[i])
        assert set(filter(None, want.split(","))) <= set(got[i]["spans"].split(","))
    plan = pii.redact(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pii_obfuscated_addresses_and_numbers_without_plus(spark):
    want = {"write to a [at] b [dot] com now": "write to [EMAIL] now", "jo.doe(at)mail.example.org": "[EMAIL]",
            "J {dot} Doe [AT] x [DOT] co [DOT] uk": "[EMAIL]", "tel: 212-555-0100 today": "tel: [PHONE] today",
            "phone no. 030 123 45 67": "phone no. [PHONE]", "Fax (212) 555-0100.": "Fax [PHONE]."}
    want |= {t: t for t in ("meet me (at) noon. then go", "hotel 12 rooms", "call 192.168.100.999 x",
                            "call 2024-01-15 10 people", "1234 5678 9012 3456")}
    got = by_id(pii.redact(spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")))
    assert [got[i]["text"] for i in range(len(want))] == list(want.values())


def test_pii_redaction_and_odd_rows(odd, none):
    got = by_id(pii.redact(odd))
    assert got[8]["text"] == "é😀 日本語 [PHONE] [EMAIL] [IP]" and got[8]["n_chars"] == len(got[8]["text"])
    assert got[1]["text"] is None and got[6]["text"] == LONG and len(got[8]) == 7
    assert pii.spans(none).count() == 0 and pii.redact(none).columns == none.columns


def merged(text, spans):
    """The text with each run of overlapping spans replaced by the kind of its first span."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out.append(text[at:start] + f"[{kind.upper()}]")
        at = max(at, end)
    return "".join(out) + text[at:]


def test_pii_cover_and_redaction_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pii, "SPAN_BLOCK", 3)
    monkeypatch.setattr(pii, "CHUNK", 5)
    rng = np.random.default_rng(7)
    rows = []
    for i in range(60):
        text = "".join(rng.choice(list("aé😀 \n.9"), rng.integers(1, 120)))
        spans = [[], []]
        for side in spans:
            for _ in range(rng.integers(0, 12)):
                start = int(rng.integers(0, len(text)))
                side.append((start, int(rng.integers(0, 5)), int(rng.integers(start + 1, len(text) + 1))))
        rows.append((i, text, sorted(spans[0]), spans[1]))
    kind = "array<struct<start:int,kind:int,end:int>>"
    df = spark.createDataFrame(rows, f"doc_id long, text string, base {kind}, more {kind}")
    got = df.select("doc_id", pii._covered(F.col("base"), F.col("more"), True).alias("own"),
                    pii._covered(F.col("base"), F.col("more"), False).alias("any_kind"),
                    pii.redacted(F.col("text"), F.col("base")).alias("out")).collect()
    assert len(got) == 60
    for r in got:
        _, text, base, more = rows[r["doc_id"]]
        assert r["any_kind"] == [any(b[0] <= c[0] and c[2] <= b[2] for b in base) for c in more]
        assert r["own"] == [any(b[1] == c[1] and b[0] <= c[0] and c[2] <= b[2] for b in base) for c in more]
        assert r["out"] == merged(text, [(s, pii.KINDS[k], e) for s, k, e in base])


def test_pii_text_of_very_many_addresses(spark):
    text = " é ".join(f"user{i}@host{i % 97}.example.org" for i in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "ann@b.org")], "doc_id long, text string")
    began = time.monotonic()
    got = by_id(pii.spans(docs))
    assert got[1]["n_email"] == 100_000 and len(got[1]["spans"].split(",")) == 100_000
    out = by_id(pii.redact(docs))
    assert out[1]["text"] == " é ".join(["[EMAIL]"] * 100_000) and out[2]["text"] == "[EMAIL]"
    assert time.monotonic() - began < 120


def test_pii_thresholds_follow_the_held_out_labels():
    card, phone = pii.KINDS.index("card"), pii.KINDS.index("phone")

    def x(kind, check):
        return (kind, 3, 4, 0, 3, 2, 1, 1, check, 0)

    rows = [(x(card, 1), False, 80.0, 80.0), (x(card, 1), True, 20.0, 20.0), (x(card, 0), False, 80.0, 0.0),
            (x(card, 0), True, 20.0, 0.0), (x(phone, 1), False, 3.0, 3.0)]
    prior, trees = pii.boost([(r[0], r[2], r[3]) for r in rows if not r[1]])
    margin = {c: prior + sum(pii._value(t, x(card, c)) for t in trees) for c in (0, 1)}
    least = pii.thresholds(rows, prior, trees)
    assert set(least) == {card} and margin[0] < least[card] <= margin[1]


# --- repeated passages ---


def brute_cut(all_texts, length=400):
    seen = Counter(t[s:s + length] for t in all_texts for s in range(len(t) - length + 1))
    out = []
    for t in all_texts:
        gone, end = bytearray(len(t)), 0
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                for j in range(max(s, end), s + length):
                    gone[j] = 1
                end = s + length
        rest = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), sum(1 for j in range(len(t)) if gone[j] and not (j and gone[j - 1])), rest))
    return out


def test_repeats_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    letters = np.frombuffer(b"abcdefgh ", np.uint8)
    passage = rng.choice(letters, 700).tobytes().decode()
    rows = []
    for i in range(40):
        head, tail = (rng.choice(letters, int(rng.integers(0, 900))).tobytes().decode() for _ in range(2))
        a, n = int(rng.integers(0, 300)), int(rng.integers(380, 700))
        rows.append(head + passage[a:a + n] + tail)
    rows += ["z" * 1500, "ab" * 700, rows[0], rows[1][:500] + "!" + rows[1][500:], "", None, "é" * 400, passage[:399]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = by_id(suffix_dedup.remove_repeats(df))
    for i, want in enumerate(brute_cut([(t or "").encode() for t in rows])):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want, i
        assert r["kept_sha256"] == hashlib.sha256(want[3]).hexdigest()


def brute_repeats(rows, length=400):
    """n_removed and kept_sha256 per document from the counts of all strings."""
    texts_ = [(t or "").encode() for _, t in rows]
    names = [[xxhash.xxh3_128_intdigest(t[s:s + length]) for s in range(len(t) - length + 1)] for t in texts_]
    seen = Counter(x for row in names for x in row)
    out = {}
    for (i, _), t, row in zip(rows, texts_, names):
        edge = np.zeros(len(t) + 1, int)
        starts = np.array([s for s, x in enumerate(row) if seen[x] > 1], int)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + length, -1)
        gone = np.cumsum(edge)[:-1] > 0
        out[i] = (int(gone.sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("most", [suffix_dedup.MAX_BROADCAST, 0])
def test_repeats_of_documents_equal_brute_force(docs, texts, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MAX_BROADCAST", most)  # 0: all pointers go by shuffle joins
    got = {r["doc_id"]: (r["n_removed"], r["kept_sha256"])
           for r in suffix_dedup.remove_repeats(docs).select("doc_id", "n_removed", "kept_sha256").collect()}
    assert got == brute_repeats(texts)


def test_repeats_odd_rows(odd, none):
    got = suffix_dedup.remove_repeats(odd).collect()
    assert len(got) == len(ROWS) and all(r["n_removed"] == r["n_bytes"] for r in got if r["doc_id"] in (6, 7))
    assert suffix_dedup.remove_repeats(none).count() == 0


# --- mixing ---


def test_mixing_stays_within_a_block(docs, odd, none):
    rows = mixing.mixed(docs.select("doc_id", "source")).collect()
    n = Counter(r["source"] for r in rows)
    names = sorted(n)
    share = [n[s] ** mixing.ALPHA for s in names]
    at = {r["slot"]: r["source"] for r in rows}
    assert len(rows) == docs.count() and len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    taken, total = Counter(), sum(share)
    for t in range(1 + max(r["slot"] for r in rows if r["on_target"])):
        taken[at[t]] += 1
        assert all(abs(taken[s] - (t + 1) * w / total) < 1 for s, w in zip(names, share))
    assert mixing.mixed(odd).count() == len(ROWS) and mixing.mixed(none).count() == 0
    given = mixing.mixed(docs.select("doc_id", "source"), {"src0": 3.0, "src1": 1.0})
    assert given.count() == docs.count()


def test_mixing_weights_of_zero(docs):
    ids = docs.select("doc_id", "source")
    names = [r["source"] for r in ids.distinct().select("source").distinct().collect()]

    def slots(weights):
        return sorted(map(tuple, mixing.mixed(ids, weights).collect()))

    assert slots({s: 0.0 for s in names}) == slots({s: 1.0 for s in names})
    first, *others = sorted(names)
    assert slots({first: 4.0, others[0]: 2.0, **{s: 0.0 for s in others[1:]}}) == slots(
        {first: 4.0, **{s: 2.0 for s in others}})
    for bad in (-1.0, math.nan, math.inf):
        with pytest.raises(ValueError, match="finite and not negative"):
            mixing.mixed(ids, {first: bad})


@pytest.mark.parametrize("weights", [[1], [1, 1], [5, 3, 2], [997, 1, 1, 1], [0.1] * 13])
def test_schedule_windows(weights):
    total = sum(map(Fraction, weights))
    share = [Fraction(w) / total for w in weights]
    blocks = [math.ceil(1000 * w) for w in share]
    on_target = [(slot, i, k) for slot, i, k, on in mixing.deal(weights, blocks) if on]
    assert len(on_target) >= 997
    for slot, i, k in on_target:
        assert math.floor(k / share[i]) <= slot < math.ceil((k + 1) / share[i])


@pytest.mark.parametrize("weights,blocks", [
    ([1 / 3] * 3, [20_000] * 3), ([0.5, 0.4999, 0.0001], [30_000, 30_000, 10]), ([math.sqrt(k) for k in range(1, 22)], [4_000] * 21)])
def test_deal_follows_the_given_weights_over_many_periods(weights, blocks):
    total, taken, last, kept = sum(map(Fraction, weights)), [0] * len(weights), -1, 0
    share = [Fraction(w) / total for w in weights]
    for slot, i, k, on_target in mixing.deal(weights, blocks):
        assert slot > last and k == taken[i] and math.floor(k / share[i]) <= slot < math.ceil((k + 1) / share[i])
        assert not on_target or slot == last + 1
        taken[i], last, kept = k + 1, slot, kept + on_target
        if on_target and not slot % 97:
            assert all(abs(t - (slot + 1) * w) < 1 for t, w in zip(taken, share))
    assert taken == blocks and kept > 30_000


def test_mixing_dealt_in_parts(spark, docs, monkeypatch):
    whole = sorted(map(tuple, mixing.mixed(docs.select("doc_id", "source")).collect()))
    monkeypatch.setattr(mixing, "PART", 7)
    monkeypatch.setattr(mixing, "MAX_BROADCAST", 7)
    monkeypatch.setattr(mixing, "MAX_OFFSETS", 0)
    assert sorted(map(tuple, mixing.mixed(docs.select("doc_id", "source")).collect())) == whole


# --- token counts ---


def test_token_counts(docs, texts, odd, none):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    whole = token_counts.Counter(path)
    got = by_id(token_counts.count_tokens(docs, path))
    for i, t in texts:
        assert got[i]["n_tokens"] == len(whole.sp.encode(t or "")) and got[i]["over_limit"] == (got[i]["n_tokens"] > 4096)
    small = token_counts.Counter(path, chunk=200, overlap=2)
    for t in [t for _, t in texts[:80]] + ["", " " * 3000, "a" * 3000, "日本語テキスト" * 300, "\n\n \t x" * 500, "▁▁ a ▁" * 300, "é😀" * 500, "<s>" * 300]:
        assert small.huge(t) == len(whole.sp.encode(t))
    assert token_counts.count_tokens(odd, path).count() == len(ROWS) and token_counts.count_tokens(none, path).count() == 0


# --- language and toxicity ---


def test_language(docs, odd, none):
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in language_id.identify(docs).collect() if r["held_out"]]
    assert held and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    got = by_id(language_id.identify(odd))
    assert all(got[i]["lang_pred"] == "und" for i in (1, 2, 3, 9)) and language_id.identify(none).count() == 0
    for n in (2, 4, 9, 40):
        code = language_id.codewords(n)
        assert len(np.unique(code, axis=0)) == n


def test_toxicity(spark, docs, odd, none):
    labels = table(spark, SF01, "labels")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in toxicity.score(docs, labels).collect() if r["held_out"] and r["doc_id"] in toxic]
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) > 0.93
    assert toxicity.score(odd, labels).count() == len(ROWS) and toxicity.score(none, labels).count() == 0
    assert toxicity.folded_words("Ѕtuр1d  ÉTÉ") == ["stupid", "ete"]
    a = toxicity.automaton({"bad": 2.0}, ["not bad"])
    assert toxicity.matched(["bad", "is", "not", "bad", "badly"], a) == (2.0, 5)


def test_toxic_words_equal_brute_force_and_long_texts():
    lexicon, phrases = {"bad": 2.0, "worse": 3.0}, ["not bad", "bad worse", "worse luck"]
    a = toxicity.automaton(lexicon, phrases)
    rng = np.random.default_rng(3)
    for n in range(200):
        words = rng.choice(["bad", "worse", "not", "luck", "so"], n % 40).tolist()
        pairs = [f"{x} {y}" in phrases for x, y in zip(words, words[1:])]
        want = sum(lexicon.get(w, 0.0) for i, w in enumerate(words)
                   if not (i < len(pairs) and pairs[i]) and not (i and pairs[i - 1]))
        assert toxicity.matched(words, a) == (want, len(words))
    began = time.monotonic()
    assert toxicity.matched(["not", "bad", "so", "bad"] * 100_000, a) == (200_000.0, 400_000)
    assert time.monotonic() - began < 20


# --- archives ---


def test_warc_odd_ids(spark, tmp_path):
    """Repeated ids are records of their own; null ids are always responses and nothing refers to them."""
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "b"), (3, "b"), (None, "b"), (None, "b"), (4, "c"), (None, "c")]
    pages = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    index = warc_bundles.write_bundles(pages, folder, min_bytes=0)
    got = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in warc_bundles.read_records(index, folder).collect())
    assert got == Counter({(1, "response", None): 2, (2, "revisit", 3): 2, (3, "response", None): 1, (None, "response", None): 3,
                           (4, "response", None): 1})


def test_warc_names_of_folders():
    assert [warc_bundles.arrow_uri(u) for u in ("s3a://b/x", "s3n://b/x", "s3://b/x", "file:/x", "/x")] == ["s3://b/x"] * 3 + ["file:///x", "/x"]


def test_warc_round_trip(spark, tmp_path, monkeypatch):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é" * 5000, "\r\n\r\nWARC/1.1", "<p>a</p>"]
    pages = spark.createDataFrame([(i, f"http://x/{i}", h, "extra") for i, h in enumerate(html)], "page_id long, url string, html string, payload string")
    folder = str(tmp_path / "warc")
    index = warc_bundles.write_bundles(pages, folder, min_bytes=0, frame_bytes=500, bundle_bytes=2000)
    got = {r["page_id"]: r for r in warc_bundles.read_records(index, folder).collect()}
    for i, h in enumerate(html):
        payload = (h or "").encode()
        first = max(j for j, o in enumerate(html) if (o or "") == (h or ""))
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"], r["url"]) == (len(payload), warc_bundles.digest(payload), f"http://x/{i}")
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == i else ("revisit", first))
        assert r["payload"] is None if first != i else bytes(r["payload"]) == payload
    monkeypatch.setattr(warc_bundles, "MAX_BROADCAST", 0)
    shuffled = warc_bundles.write_bundles(pages, str(tmp_path / "shuffled"), min_bytes=0)
    assert {r["page_id"]: r for r in warc_bundles.read_records(shuffled, str(tmp_path / "shuffled")).collect()} == got
    one = warc_bundles.read_records(index.where("page_id = 4"), folder).collect()
    assert [r["page_id"] for r in one] == [4] and bytes(one[0]["payload"]) == ("é" * 5000).encode()
    assert warc_bundles.write_bundles(pages.where("false"), folder).count() == 0
