"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base spans (e-mail, IP, card, phone) are found leftmost and non-overlapping
per kind and checked by format. High-recall generators propose further spans,
which may overlap the base and each other: digit groups beside other numbers,
obfuscated addresses, keys and tokens. Each candidate has small integer
features of its format (length, digit share, letter case, separators, distinct
characters, checks) and its context (characters around it, cue words). Boosted
trees are fitted to weak labels: a candidate that a checked base span of its
kind covers, an obfuscated address that is one when unfolded, a number of 9 to
15 digits after a phone cue, or a key that an assignment or a known prefix
introduces. Plausible candidates without a label (their check holds) are left
out of the fit; the others are its negatives. A kind's threshold is the lowest
margin of a labelled positive at which the precision on a held-out fold (on all
folds, if it has under ``MIN_HELD`` candidates of the kind) is ``PRECISION`` or
more; the candidates that reach it become spans beside the base. Only where a
table has too few labels of a kind for a threshold, its unfolded addresses and
cued numbers are spans by their format check.

Candidates of all documents are summed into one row per combination of
features before they are fitted: their number is bounded by the product of the
feature ranges (in practice a few hundred), so the fit sees every candidate and
only that table reaches the driver. The trees are then one SQL expression.
No Python code runs on the executors and texts are never shuffled. Base spans
and candidates of a text are merged by start, so that a text of very many spans
costs time in proportion.

Edge cases. Null is an empty text without spans. Repeated rows get equal
results; a null doc_id counts to the fitted folds. Without candidates no model
is fitted and only base spans remain. Extra columns are ignored by ``spans``
and passed through by ``redact``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import fold, prepare, saved

KINDS = ["email", "ip", "card", "phone", "secret"]  # the order of equal starts

# Base patterns. The look-behinds and possessive loops only spare the matcher starts and retries that
# cannot change what is found: a run of address characters or digits is tried once, from its first
# character or from the end of the last match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE_GATE = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"

# Candidate generators; the last group holds the character after the candidate.
AFTER = r"(?=([\s\S]?))"
AT, DOT = r" {0,2}(?:\[at\]|\(at\)|\{at\}) {0,2}", r" {0,2}(?:\[dot\]|\(dot\)|\{dot\}) {0,2}"
PHONE_CUE = r"(?<![A-Za-z])(?:tele)?(?:phone|tel|call|fax|mobile)(?:[ .]{1,2}(?:no|nr|number))?[^0-9A-Za-z]{0,4}"
GENERATORS = {
    "email": rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+(?:{DOT}[A-Za-z0-9_%+-]{{1,64}}+){{0,3}}{AT}[A-Za-z0-9-]++"
             rf"(?:\.| {{1,2}}\. {{1,2}}|{DOT})[A-Za-z]{{2,}}+(?:(?:\.|{DOT})[A-Za-z]{{2,}}+){{0,4}}",
    "ip": r"(?<![0-9])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+?[0-9]{1,3}[ .-])?+\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
             rf"|(?=[(0-9])(?<=(?i:{PHONE_CUE}))(?![0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}(?![0-9.])|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?![0-9]))"
             r"\(?[0-9](?:[ ().-]{0,2}[0-9]){8,14}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{14})(?:AKIA[A-Z0-9]{16}|[A-Za-z_-]{0,60}+[0-9][A-Za-z0-9_-]*+)",
}
GENERATOR_GATE = {"email": r"(?i)[\[({]at[\])}]", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{4}", "phone": "[0-9]{4}|(?i:phone|tel|call|fax|mobile)",
                  "secret": "[A-Za-z0-9_-]{14}"}
MIN_SECRET = 14
HIT_BLOCK = 100
_HITS = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"
BEFORE = 24  # characters of context before a candidate
CUES = r"(?i)(?:phone|tel|call|fax|mobile|card|visa|account|host|server|mail|contact)[^0-9A-Za-z]{0,4}$"
SECRET_CUES = r"(?i)(?:password|passwd|pwd|token|secret|key|auth|bearer)[\"' ]{0,3}[:=][\"' ]{0,3}$"
SECRET_PREFIX = "AKIA"

FEATURES = {"kind": 5, "length": 11, "digit_share": 6, "letter_case": 4, "separators": 5, "distinct": 8,
            "before": 7, "after": 7, "check": 2, "cue": 2}
FOLDS = 5  # one of them held out for the thresholds
TREES, DEPTH, RATE = 20, 3, 0.3
PRECISION = 0.8  # of the weak labels above a kind's threshold, on the held-out fold
MIN_LEAF = 5
MIN_HELD = 20
SPAN_BLOCK = 100  # spans of a text whose running maximum is taken at once
CHUNK = 1024  # code points of a text that a cut of it starts from


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is made once: inside a lambda an expression is made anew at each step."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running_max(values: Column) -> Column:
    """Running maxima of an array of longs: within blocks, then over the blocks."""
    def within(block: Column) -> Column:
        return F.transform(block, lambda _, j: F.array_max(F.slice(block, 1, j + 1)))

    def raised(parts: Column, tops: Column) -> Column:
        before = F.transform(tops, lambda _, j: F.array_max(F.slice(tops, F.lit(1), j)))
        return F.flatten(F.zip_with(parts, before, lambda part, top: F.transform(part, lambda x: F.greatest(x, top))))

    def blocks(v: Column) -> Column:
        last = F.ceil(F.size(v) / SPAN_BLOCK).cast("int") - 1
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: _let(F.slice(v, i * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)), within))
        maxima = _let(parts, lambda p: _let(F.transform(p, lambda x: F.element_at(x, -1)), lambda tops: raised(p, tops)))
        return F.when(last >= 0, maxima).otherwise(F.lit([]).cast("array<bigint>"))

    return _let(values, blocks)


def _covered(base: Column, more: Column, same_kind: bool) -> Column:
    """array<boolean>: whether a base span (of the same kind) covers each span of ``more``. Both are merged by
    start; a span is covered if a base span that began before it or with it ends with it or later. Positions of a
    kind are moved past those of the kinds before it, so that only its own spans can reach them."""
    def at(span: Column, end: str) -> Column:
        return span[end].cast("long") + (F.shiftleft(span["kind"].cast("long"), 32) if same_kind else F.lit(0))

    events = F.array_sort(F.concat(
        F.transform(base, lambda b: F.struct(at(b, "start").alias("start"), F.lit(-1).alias("pos"), at(b, "end").alias("end"))),
        F.transform(more, lambda c, i: F.struct(at(c, "start").alias("start"), i.alias("pos"), at(c, "end").alias("end")))))

    def flags(e: Column) -> Column:
        reach = _running_max(F.transform(e, lambda x: F.when(x["pos"] < 0, x["end"]).otherwise(F.lit(0))))
        return F.zip_with(e, reach, lambda x, top: F.struct(x["pos"].alias("pos"), (top >= x["end"]).alias("inside")))

    return F.transform(F.array_sort(F.filter(_let(events, flags), lambda f: f["pos"] >= 0)), lambda f: f["inside"])


def _hits(text: Column, pattern: str, after: bool) -> Column:
    """array<start, end, hit, before, after> of the matches, in code points. The matches are joined with the
    gaps between them; all arrays are arguments of their function, so that each is made once per text."""
    found = F.regexp_extract_all(text, F.lit(pattern + AFTER if after else pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rows = F.zip_with(gaps, found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    if after:
        follows = F.regexp_extract_all(text, F.lit(pattern + AFTER), F.lit(1))
        rows = F.zip_with(rows, follows, lambda row, c: F.struct(row["gap"].alias("gap"), row["hit"].alias("hit"), c.alias("after")))
    rows = F.filter(rows, lambda row: row["hit"].isNotNull())

    def step(acc: Column, row: Column) -> Column:
        start = acc["at"] + F.length(row["gap"])
        end = start + F.length(row["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), row["hit"].alias("hit"),
                       F.right(row["gap"], F.lit(BEFORE)).alias("before"),
                       (row["after"] if after else F.lit("")).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    # Running sums in blocks of rows, then over the blocks: a text with k hits costs k * HIT_BLOCK, not k * k.
    none = F.lit([]).cast(_HITS)

    def blocks(r: Column) -> Column:
        count = F.ceil(F.size(r) / HIT_BLOCK).cast("int")
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.aggregate(
            F.slice(r, i * HIT_BLOCK + 1, F.lit(HIT_BLOCK)), F.struct(F.lit(0).alias("at"), none.alias("out")), step)))

    def shift(h: Column, by: Column) -> Column:
        return F.struct((h["start"] + by).alias("start"), (h["end"] + by).alias("end"), h["hit"].alias("hit"),
                        h["before"].alias("before"), h["after"].alias("after"))

    def joined(parts: Column) -> Column:
        ends = F.aggregate(parts, F.array(F.lit(0)), lambda acc, part: F.concat(acc, F.array(F.element_at(acc, -1) + part["at"])))
        return F.flatten(F.zip_with(parts, F.slice(ends, 1, F.size(parts)), lambda part, by: F.transform(
            part["out"], lambda h: shift(h, by))))

    parts = F.element_at(F.transform(F.array(rows), blocks), 1)  # one-element arrays hold a value that is made once
    return F.coalesce(F.element_at(F.transform(F.array(parts), joined), 1), none)


def _gated(text: Column, gate: str, hits: Column) -> Column:
    return F.when(text.rlike(gate), hits).otherwise(F.lit([]).cast(_HITS))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn check of a string of 12 to 19 digits; false for other lengths."""
    def value(i: Column) -> Column:
        v = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return F.when(v > 9, v - 9).otherwise(v)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + value(i))
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def _valid(kind: str, hits: Column) -> Column:
    if kind == "ip":
        return F.filter(hits, lambda h: h["hit"].rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"))
    if kind == "card":
        return F.filter(F.filter(hits, lambda h: F.length(h["hit"]).between(12, 37)), lambda h: _luhn(_digits(h["hit"])))
    if kind == "phone":
        return F.filter(hits, lambda h: F.length(_digits(h["hit"])).between(9, 15))
    return hits


def _ordered(hits: Column, kind: str) -> Column:
    """Hits as sortable spans."""
    return F.transform(hits, lambda h: F.struct(h["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), h["end"].alias("end")))


def _char_class(c: Column) -> Column:
    return (F.when(F.coalesce(c, F.lit("")) == "", 0).when(c.rlike(r"^\s$"), 1).when(c == "=", 2).when(c.isin('"', "'"), 3)
            .when(c.rlike("^[A-Za-z]$"), 4).when(c.rlike("^[0-9]$"), 5).otherwise(6))


def _candidate(kind: str, h: Column) -> Column:
    hit, n = h["hit"], F.length(h["hit"])
    digits = F.length(_digits(hit))
    check = {"ip": hit.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"), "card": _luhn(_digits(hit)),
             "phone": digits.between(9, 15)}.get(kind, F.lit(False))
    cue = F.lit(False) if kind == "secret" else h["before"].rlike(CUES)
    known = F.lit(False)
    if kind == "secret":
        known = h["before"].rlike(SECRET_CUES) | F.startswith(hit, F.lit(SECRET_PREFIX))
    elif kind == "email":
        known = F.regexp_replace(F.regexp_replace(hit, f"(?i){AT}", "@"), f"(?i){DOT}", ".").rlike(f"^{BASE['email']}$")
    elif kind == "phone":
        known = h["before"].rlike(f"(?i){PHONE_CUE}$") & check
    unsure = F.lit(True) if kind == "email" else check
    return F.struct(
        h["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), h["end"].alias("end"), known.alias("known"), unsure.alias("unsure"),
        F.least(F.floor(n / 4), F.lit(10)).cast("int").alias("length"),
        F.floor(digits * 5 / n).cast("int").alias("digit_share"),
        (hit.rlike("[a-z]").cast("int") + 2 * hit.rlike("[A-Z]").cast("int")).alias("letter_case"),
        F.least(F.length(F.regexp_replace(hit, "[A-Za-z0-9]", "")), F.lit(4)).alias("separators"),
        F.least(F.floor(F.size(F.array_distinct(F.split(hit, ""))) / 3), F.lit(7)).cast("int").alias("distinct"),
        _char_class(F.right(h["before"], F.lit(1))).alias("before"), _char_class(h["after"]).alias("after"),
        check.cast("int").alias("check"), cue.cast("int").alias("cue"))


def _candidates(kind: str, hits: Column) -> Column:
    return F.transform(hits, lambda h: _candidate(kind, h))


def _count(kind: int) -> Column:
    return F.size(F.filter("pii_base", lambda b: b["kind"] == kind)).cast("long")


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``pii_base`` (sorted checked spans) and ``pii_more`` (candidates with features, the weak label and
    whether a base span covers them); the names and ``pii_raw`` must be free."""
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = F.array_sort(F.concat(*(
        _ordered(_valid(k, _gated(content, BASE_GATE[k], _hits(content, p, False))), k) for k, p in BASE.items())))
    hits = []
    for kind, pattern in GENERATORS.items():
        found = _gated(content, GENERATOR_GATE[kind], _hits(content, pattern, True))
        if kind == "secret":
            found = F.filter(found, lambda h: F.length(h["hit"]) >= MIN_SECRET)
        hits.append(_candidates(kind, found))
    found = df.withColumn("pii_base", base).withColumn("pii_raw", F.concat(*hits))
    cover = F.zip_with(_covered(F.col("pii_base"), F.col("pii_raw"), True), _covered(F.col("pii_base"), F.col("pii_raw"), False),
                       lambda own, any_kind: F.struct(own.alias("own"), any_kind.alias("inside")))
    marked = F.zip_with("pii_raw", cover, lambda c, by: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["known"].alias("known"), c["unsure"].alias("unsure"),
        (by["own"] | c["known"]).alias("label"), by["inside"].alias("inside"), *(c[f].alias(f) for f in FEATURES)))
    return found.withColumn("pii_more", marked).drop("pii_raw")


# --- boosted trees over the table of feature combinations ---------------------------------------------------

Row = tuple[tuple[int, ...], float, float]  # features, candidates, positives


def _tree(rows: list[tuple[tuple[int, ...], float, float]], depth: int):
    """A regression tree on (features, gradient, hessian): a leaf value or (feature, threshold, left, right)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (1e-6, None)
    if depth and len(rows) > 1:
        for f in range(len(rows[0][0])):
            by: dict[int, list[float]] = {}
            for x, gi, hi in rows:
                cell = by.setdefault(x[f], [0.0, 0.0])
                cell[0] += gi
                cell[1] += hi
            gl = hl = 0.0
            for v in sorted(by)[:-1]:
                gl, hl = gl + by[v][0], hl + by[v][1]
                if hl < 1e-3 or h - hl < 1e-3:
                    continue
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, v))
    if best[1] is None:
        return RATE * g / (h + 1)
    f, v = best[1]
    return (f, v, _tree([r for r in rows if r[0][f] <= v], depth - 1), _tree([r for r in rows if r[0][f] > v], depth - 1))


def _value(tree, x: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def boost(rows: list[Row]) -> tuple[float, list]:
    """Logistic gradient boosting: the prior's log odds and the trees."""
    n, pos = sum(r[1] for r in rows), sum(r[2] for r in rows)
    prior = math.log((pos + 1) / (n - pos + 1))
    margin = [prior] * len(rows)
    trees = []
    for _ in range(TREES):
        step = []
        for (x, c, p), m in zip(rows, margin):
            q = 1 / (1 + math.exp(-m))
            step.append((x, p - c * q, c * q * (1 - q)))
        trees.append(_tree(step, DEPTH))
        margin = [m + _value(trees[-1], r[0]) for r, m in zip(rows, margin)]
    return prior, trees


def thresholds(rows: list[tuple[tuple[int, ...], bool, float, float]], prior: float, trees: list) -> dict[int, float]:
    """Least margin per kind, from rows (features, held out, candidates, positives); kinds with too few have none."""
    out = {}
    for kind in range(len(KINDS)):
        own = [r for r in rows if r[0][0] == kind]
        few = sum(r[2] for r in own if r[1]) < MIN_HELD
        by: dict[float, list[float]] = {}
        for x, held, n, pos in own:
            cell = by.setdefault(prior + sum(_value(t, x) for t in trees), [0.0, 0.0, 0.0])
            cell[0] += n if held or few else 0.0
            cell[1] += pos if held or few else 0.0
            cell[2] += pos
        n = pos = 0.0
        for margin in sorted(by, reverse=True):
            n, pos = n + by[margin][0], pos + by[margin][1]
            if n >= MIN_LEAF and pos >= PRECISION * n and by[margin][2]:
                out[kind] = margin - 1e-9
    return out


def _tree_sql(tree, x: list[Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(x[tree[0]] <= tree[1], _tree_sql(tree[2], x)).otherwise(_tree_sql(tree[3], x))


def fit(candidates: DataFrame) -> tuple[float, list, dict[int, float]] | None:
    """Model of ``candidates`` (doc_id, pii_more): prior, trees, and the margin threshold per kind."""
    c = candidates.select("doc_id", F.explode("pii_more").alias("c")).where("c.label or not c.unsure")
    c = c.select((F.coalesce(fold(F.col("doc_id"), FOLDS), F.lit(1)) == 0).alias("held"),
                 F.col("c.label").cast("long").alias("label"), *(F.col(f"c.{f}") for f in FEATURES))
    table = c.groupBy("held", *FEATURES).agg(F.count("*").alias("n"), F.sum("label").alias("pos")).collect()
    rows = sorted((tuple(r[f] for f in FEATURES), bool(r["held"]), float(r["n"]), float(r["pos"])) for r in table)
    fitted = [(x, n, pos) for x, held, n, pos in rows if not held]
    if not fitted:
        return None
    prior, trees = boost(fitted)
    return prior, trees, thresholds(rows, prior, trees)


def all_spans(base: Column, more: Column, model) -> Column:
    """Base spans and the selected candidates that no base span covers, sorted by start, kind and end."""
    prior, trees, least = model or (0.0, [], {})

    def chosen(c: Column) -> Column:
        by_format = c["known"] & c["kind"].isin(KINDS.index("email"), KINDS.index("phone"))
        if not least:
            return by_format
        need = F.lit(None).cast("double")
        for kind, t in least.items():
            need = F.when(c["kind"] == kind, F.lit(t)).otherwise(need)
        margin = sum((_tree_sql(t, [c[f] for f in FEATURES]) for t in trees), F.lit(prior))
        return F.coalesce(margin >= need, by_format)

    kept = F.filter(more, lambda c: ~c["inside"] & chosen(c))
    return F.array_sort(F.concat(base, F.transform(kept, lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))))


def _name(kind: Column) -> Column:
    return F.element_at(F.array(*(F.lit(k) for k in KINDS)), kind + 1)


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", _name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, counts of base spans per kind, base_sha256, spans (text)."""
    prepare(docs.sparkSession)
    found = saved(with_candidates(docs.select("doc_id", "text"), "text").drop("text"))
    model = fit(found)
    count = [_count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return found.select("doc_id", *count, F.sha2(_text(F.col("pii_base")), 256).alias("base_sha256"),
                        _text(all_spans(F.col("pii_base"), F.col("pii_more"), model)).alias("spans"))


def redacted(text: Column, found: Column) -> Column:
    """``text`` with every run of overlapping spans replaced by the kind of its first span, as ``[KIND]``."""
    def cut(chunks: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / CHUNK).cast("int")
        parts = F.slice(chunks, first + 1, F.floor((b - 1) / CHUNK).cast("int") - first + 1)
        return F.when(b > a, F.substring(F.array_join(parts, ""), (a - first * CHUNK + 1).cast("int"), (b - a).cast("int"))).otherwise(F.lit(""))

    def runs(reach: Column) -> Column:
        spans_ = F.zip_with(found, F.concat(F.array(F.lit(0).cast("long")), reach), lambda s, before: F.struct(
            before.alias("from"), s["start"].alias("start"), s["kind"].alias("kind")))
        return F.filter(spans_, lambda s: s["start"] >= s["from"])

    def joined(chunks: Column, reach: Column) -> Column:
        parts = F.transform(runs(reach), lambda s: F.concat(
            cut(chunks, s["from"], s["start"].cast("long")), F.lit("["), F.upper(_name(s["kind"])), F.lit("]")))
        return F.concat(F.array_join(parts, ""), cut(chunks, F.element_at(reach, -1), F.length(text).cast("long")))

    chunks = F.regexp_extract_all(text, F.lit(rf"[\s\S]{{1,{CHUNK}}}"), F.lit(0))
    reach = _running_max(F.transform(found, lambda s: s["end"].cast("long")))
    return F.when(F.size(found) > 0, _let(chunks, lambda c: _let(reach, lambda r: joined(c, r)))).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``text`` replaced by ``[KIND]``; null texts stay null, other columns unchanged
    (n_chars, if there, is set to the new length)."""
    prepare(docs.sparkSession)
    model = fit(saved(with_candidates(docs.select("doc_id", "text"), "text").drop("text")))
    inner = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    found = with_candidates(inner, at["text"])
    found = found.withColumn("pii_all", all_spans(F.col("pii_base"), F.col("pii_more"), model))
    found = found.withColumn("pii_text", F.when(F.col(at["text"]).isNotNull(), redacted(F.col(at["text"]), F.col("pii_all"))))
    out = {c: F.col(at[c]) for c in docs.columns} | {"text": F.col("pii_text")}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col(at["n_chars"]).isNotNull(), F.length("pii_text").cast(docs.schema["n_chars"].dataType))
    return found.select(*(out[c].alias(c) for c in docs.columns))
