"""Chat formatting, ranked search and collocations against brute force, round trips and odd inputs."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm import chat_format, collocations, common, lexical_search

DOCS = "doc_id long, text string, lang string, score string, n int"


# --- chat formatting ---

CONV = "conv_id long, turn long, role string, text string, place int, error string"
TRICKY = ["<|im_end|>", "<\\|im_end|>", "<<\\\\||", "\\", "<", "|", "", "<|im_start|>user\nx<|im_end|>\n", "a\nb", "<\\n|"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\\nnaé"), st.text(alphabet="<|\\\nnaé"))
def test_turns_are_reversible(role, text):
    t = chat_format.CHATML
    formatted = "".join(s for s, _ in t.turn(role, text))
    found = t.parser().fullmatch(formatted)
    assert t.unescape_role(found["role"]) == role and t.unescape(found["text"]) == text
    assert formatted.count(t.opener) == 2  # the template's own


def test_conversations_by_brute_force(spark):
    rows = [(c, i, ("user", "assistant")[i % 2], TRICKY[(c + i) % len(TRICKY)], 0, "x") for c in range(30) for i in range(c % 7 + 1)]
    frame = spark.createDataFrame(rows, CONV).repartition(5)
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(frame)).collect()}
    assert set(got) == set(range(30))
    for c, r in got.items():
        turns = [x for x in rows if x[0] == c]
        trained = "".join(x[3] for x in turns if x[2] == "assistant")
        assert r["n_turns"] == len(turns) and r["n_errors"] == 0 and r["first_error"] is None
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(trained), hashlib.sha256(trained.encode()).hexdigest())


def test_role_machine(spark):
    def errors(*roles):
        frame = spark.createDataFrame([(1, i, r, "t", 0, "") for i, r in enumerate(roles)], CONV)
        return [r["error"] for r in chat_format.format_turns(frame).orderBy("place").collect()]

    assert errors("system", "user", "assistant", "user") == [None] * 4
    assert errors("assistant", "user") == ["'assistant' as first turn", None]
    assert errors("user", "user", "tool", "assistant", "system") == [
        None, "'user' after 'user'", "'tool' after 'user'", None, "'system' after 'assistant'"]


def test_chat_odd_rows(spark):
    rows = [(None, 0, "user", None, 0, ""), (None, 1, "assistant", "é😀", 0, ""), (5, None, None, "x", 1, ""),
            (5, 0, "user\n<|", "y", 1, ""), (6, 0, "user", "z", 1, ""), (6, 0, "user", "z", 1, ""),
            (7, 0, "user", "long " * 200_000, 1, "")]
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(spark.createDataFrame(rows, CONV))).collect()}
    assert got[None]["loss_chars"] == 2 and got[None]["n_turns"] == 2 and got[5]["n_errors"] == 2
    assert got[5]["turns_sha256"] == hashlib.sha256(b"\nx\nuser\n<|\ny\n").hexdigest()
    assert got[6]["n_turns"] == 2 and got[7]["formatted_chars"] == 1_000_000 + 12 + 10 + 4 + 2
    assert chat_format.read_back(chat_format.format_turns(spark.createDataFrame([], CONV))).count() == 0


def test_template_checks():
    with pytest.raises(ValueError):
        chat_format.Template((chat_format.Segment("control", "[x]"), chat_format.Segment("role"), chat_format.Segment("text")), {})
    with pytest.raises(ValueError):
        chat_format.Template((chat_format.Segment("text"),), {})


# --- ranked search ---

def ranked(docs, items, k):
    """The contract, in Python integers."""
    word = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    terms = {i: word.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (t or "").encode())) for i, t in enumerate(t for _, t in docs)}
    count = sum(bool(t) for t in terms.values())
    total = sum(map(len, terms.values()))
    df = Counter(t for own in terms.values() for t in set(own))
    out = []
    for item, text in items:
        query = word.findall((text or "").encode().lower())
        scores = []
        for i, own in terms.items():
            tf = Counter(own)
            m = 75 + 25 * len(own) * count // total if total else 75
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
                    for t in query if tf[t])
            if s > 0:
                scores.append((-s, docs[i][0] is None, docs[i][0] or 0))
        out += [(item, n + 1, None if null else d, -s) for n, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k=5):
    got = lexical_search.search(spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOCS).repartition(4),
                                spark.createDataFrame(items, "item_id long, text string"), k)
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.fixture()
def corpus():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)] + ["É", "日本語", "Ab-cd"]
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(0, 40))))) for i in range(300)]
    docs += [(1000 + i, docs[7][1] or "w1 w2") for i in range(40)] + [(None, "w1 w2 w3"), (None, None), (2000, ""), (2000, "w1 w1"), (2000, "w1 w1")]
    items = [(i, " ".join(rng.choice(words, 8))) for i in range(20)] + [(20, "w1 " * 50), (21, None), (22, "unknown"), (23, "!!"), (24, docs[7][1])]
    return docs, items


def test_search_by_brute_force(spark, corpus, monkeypatch):
    docs, items = corpus
    want = ranked(docs, items, 5)
    assert found(spark, docs, items) == want
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 300)  # many blocks
    monkeypatch.setattr(lexical_search, "ITEM_TILE", 2)
    monkeypatch.setattr(lexical_search, "TERM_TILE", 3)
    monkeypatch.setattr(lexical_search, "DOC_TILE", 7)
    assert found(spark, docs, items) == want


def test_search_tiles_stay_exact():
    weights = np.array([20_000, 1, 0, 15_000])
    counts = [{0: 1_000_000, 1: 3, 3: 5}, {0: 2, 2: 9}, {}]
    tiles = lexical_search.item_tiles(counts, weights)
    total = Counter()
    for first, terms, rows, columns, n in tiles:
        bound = np.zeros(len(counts))
        for r, j, c in zip(rows, columns, n):
            total[first + int(r), int(terms[j])] += int(c)
            bound[r] += int(c) * int(weights[terms[j]]) * lexical_search.TOP
        assert bound.max() < lexical_search.EXACT
    assert len(tiles) > 1 and total == {(0, 0): 1_000_000, (0, 1): 3, (0, 3): 5, (1, 0): 2}


def test_search_joins_items_and_takes_empty_tables(spark):
    docs = [(1, "a b"), (2, "b c")]
    assert [r[:3] for r in found(spark, docs, [(1, "a"), (1, "c"), (None, "c")])] == [(1, 1, 1), (1, 2, 2), (None, 1, 2)]
    assert found(spark, [], [(1, "a")]) == [] and found(spark, docs, []) == [] and found(spark, docs, [(1, None)]) == []
    assert found(spark, [(3, "word " * 300_000)], [(1, "word")])[0][:3] == (1, 1, 3)


# --- collocations ---

def mined(rows, longest, least, inside, top):
    """The contract, in Python integers."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    hidden = set()
    for (lang, p), c in found.items():
        for k in range(2, len(p)):
            hidden.update((lang, p[i:i + k]) for i in range(len(p) - k + 1) if 100 * c >= inside * f[lang, p[i:i + k]])
    out = {}
    for (lang, p), a in found.items():
        if (lang, p) not in hidden:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, own in out.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:top]))


@pytest.fixture(scope="module")
def prose():
    rng = np.random.default_rng(4)
    words = ["the", "The", "of", "é", "zz\x00", "\x1c", "日本", "a-b"] + [f"w{i}" for i in range(12)]
    fixed = ["new york city hall", "new york", "once upon a time there was"]
    rows = []
    for i in range(120):
        parts = [str(x) for x in rng.choice(words, int(rng.integers(1, 60)), p=np.arange(20, 0, -1) / 210)]
        parts.insert(int(rng.integers(0, len(parts) + 1)), fixed[i % 3])
        text = "".join(p + str(rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "])) for p in parts)
        rows.append((("en", "de", None)[i % 3 if i % 4 else 0], text))
    rows += [("en", " ".join(str(x) for x in rng.choice(words, 4000)))] + [rows[5]] * 6 + [("de", None), ("xx", ""), ("xx", " .,"), (None, "one")]
    return rows


@pytest.mark.parametrize("longest,least,inside,top,shard_words", [
    (5, 5, 100, 2_000, 1_000_000), (5, 5, 100, 50, 97), (5, 4, 60, 2_000, 11), (4, 3, 100, 2_000, 300), (2, 5, 100, 20, 50)])
def test_collocations_by_brute_force(spark, prose, longest, least, inside, top, shard_words):
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(prose)], DOCS).repartition(4)
    got = collocations.collocations(docs, longest, least, inside, top, shard_words)
    assert sorted(tuple(r) for r in got.collect()) == mined(prose, longest, least, inside, top)


def test_slices_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 3)
    text = b"One two.three\tfour,five  six\n\x00 . seven"
    assert [w for s in collocations.word_slices(text) for w in s] == [
        b"one", b"two", b".", b"three", b"four", b".", b"five", b"six", b".", b"\x00", b".", b"seven"]
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, "en", "s", 1)], DOCS)).count() == 0


def test_index_counts_every_phrase():
    rng = np.random.default_rng(2)
    ids = collocations.squeezed(rng.choice(6, 500, p=[.2, .4, .1, .1, .1, .1]))
    index = collocations.Index(ids, 5)
    phrases = index.words()
    for k, left in ((2, True), (3, False), (4, True), (5, True)):
        phrases = index.extend(phrases, left)
        want = Counter(tuple(w) for w in (ids[i:i + k].tolist() for i in range(len(ids) - k + 1)) if 0 not in w)
        assert Counter({tuple(p): int(c) for p, c in zip(phrases[0].tolist(), phrases[3])}) == want


def test_a_shard_counts_in_a_row_a_bucket():
    """not a row for each phrase, whose number grew faster than the text; sums and answers stay exact."""
    rng = np.random.default_rng(6)
    gid = np.sort(rng.choice(1 << 40, 200, replace=False))
    shards, want = [], Counter()
    for shard, sign in ((1, 1), (2, 1), (3, -1)):
        ids = rng.choice(201, 9_000)
        shards += collocations._numbered(shard, sign, ids, gid)
        for i in range(len(ids) - 2):
            if ids[i:i + 3].all():
                want[tuple(gid[ids[i:i + 3] - 1].tolist())] += sign
    for row in shards:
        assert len(list(collocations._triples(iter([row]), buckets=8))[0]) == 8
    counted = pa.Table.from_batches(collocations._triples(iter(shards), buckets=8))
    sums = pa.concat_tables(collocations._totals(counted.filter(pc.equal(counted["bucket"], b)), 2) for b in range(8)).to_pylist()
    found = {tuple(r["key"]): r["f"] for r in sums if r["f"] is not None}
    assert found == {k: f for k, f in want.items() if f >= 2} and len(found) > 10
    for row in shards:
        shard, _, ids, own = (c[0].as_py() for c in row.columns)
        words = np.array(own)[collocations.threes_of(collocations.Index(collocations.unpacked(ids), 3))[0] - 1]
        told = collocations._often(words, 8, [r for r in sums if r["shard"] == shard])
        assert told.tolist() == [tuple(w) in found for w in words.tolist()]


def test_packed_columns():
    for rows in (np.array([[5, -3, 2**62]]), np.random.default_rng(0).integers(-2**40, 2**40, (300, 4))):
        got = collocations.unpacked_columns(collocations.packed(*rows.T), rows.shape[1])
        assert (got == rows.T).all()


def test_only_answers_are_shuffled_to_bucketed_rows(spark):
    """the shards' words, most of the bytes, stay in place when a join by the shard brings what is told of them."""
    rows = spark.range(100).selectExpr("id as shard", "repeat('x', 100) as ids")
    kept = common.bucketed(rows, "shard", 4)
    joined = kept.join(spark.range(50).selectExpr("id as shard", "'y' as told").repartition(3).hint("merge"), "shard")
    plan = joined._jdf.queryExecution().sparkPlan().toString() + joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50 and plan.count("hashpartitioning(shard") == 1
    assert spark.catalog.listTables() == [] or not any(t.name.startswith("bucketed_") for t in spark.catalog.listTables())


# --- decontamination: recall of edited copies ---

def edited(rng, words, rate, pool):
    out = []
    for w in words:
        kind = rng.random()
        if kind < rate / 3:
            out.append(str(rng.choice(pool)))
        elif kind < 2 * rate / 3:
            out += [w, str(rng.choice(pool))]
        elif kind >= rate:
            out.append(w)
    return out


def test_leaks_of_edited_copies(spark):
    """Every edited copy whose whole alignment reaches the threshold is found, at 10 to 30 % edits."""
    from tierlake.llm import decontaminate as dc

    rng = np.random.default_rng(8)
    pool = [f"p{i}" for i in range(900)] + ["the", "of", "and", "é", "Über"] * 20
    items = [(i, " ".join(str(x) for x in rng.choice(pool, int(rng.integers(15, 60))))) for i in range(60)]
    rows, truth = [], {}
    for rate in (0.1, 0.2, 0.3):
        for i, text in items:
            copy = edited(rng, text.split(), rate, pool)
            around = [str(x) for x in rng.choice(pool, 80)]
            words = around[:40] + copy + around[40:]
            own = dc.Items([(i, text)])
            ids = own.text_keys(" ".join(words))[0]
            score = dc.align(own.words[0], ids)[0] / (dc.MATCH * len(own.words[0]))  # over the whole text
            truth[len(rows)] = (rate, i, score >= dc.MIN_SCORE)
            rows.append((len(rows), " ".join(words)))
    got = {(r["doc_id"], r["item_id"]) for r in dc.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for rate in (0.1, 0.2, 0.3):
        due = [(d, i) for d, (r, i, leaked) in truth.items() if r == rate and leaked]
        assert len(due) > 30 and sum(x in got for x in due) / len(due) >= 0.97


def test_leak_words_are_unicode_words():
    from tierlake.llm.decontaminate import norm_words

    for text in ("Ab_c d-e 12", "É tÉ x", "日本 ÜBER,z", "a\x00b", "", None, "ß Q"):
        assert [w.decode() for w in norm_words(text)] == re.findall(r"\w+", (text or "").lower())
