"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose candidate spans. Labelers vote on each: a regex check, a gazetteer of words
before the span, its context and its shape. Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is and how likely each pattern is personal data;
a logistic span classifier is trained on those soft labels and decides. Spans of the base
rules always stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import written

#: Kinds in order of their spans; the patterns that propose them. The possessive loops and the
#: look-behinds find what the plain patterns find, but in linear time and without deep stacks.
BASE = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "national": r"(?<![0-9+(). -])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])[A-Za-z0-9_]{20,}+",
}
KINDS = tuple(PATTERNS)
#: What a text must hold for a kind to be searched.
NEEDS = {"email": "@", **dict.fromkeys(("ip", "card", "phone", "national", "secret"), "[0-9]")}
#: Gazetteers of words before a span that speak for or against it.
SPEAKS = {
    "email": "mail|contact|write|reach|from|cc", "ip": r"\bip\b|host|server|addr|client|remote",
    "card": "card|visa|credit|account|payment|iban", "phone": "phone|tel|call|mobile|fax|cell",
    "national": "phone|tel|call|mobile|fax|cell", "secret": "key|token|secret|passw|credential|akia|auth",
}
AGAINST = "version|license|isbn|page|chapter|order no|article"
#: Characters of left context; EM rounds; classifier steps.
CONTEXT, ROUNDS, STEPS = 32, 30, 400
#: Characters of the blocks from which the text between masked spans is cut.
BLOCK = 1024
LABELERS = ("v_regex", "v_gazetteer", "v_context", "v_shape")
FEATURES = ("f_check", "f_left", "f_right", "f_word", "f_rich", "f_len", "f_digits")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        d = F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return total + d

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def base_valid(kind: str, m: Column) -> Column:
    """The base rule's check of a match (false for kinds that only the method adds)."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                        & (F.substring(F.concat(F.lit("00"), p), -3, 3).cast("int") <= 255))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(False)


def signals(kind: str, m: Column, tail: Column, head: Column) -> dict[str, Column]:
    """Labelers' votes (1, 0, -1) and classifier features of a candidate and its surroundings."""
    digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    if kind == "secret":
        check = m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (m.rlike("^[0-9a-f]+$") | m.rlike("^[A-Z0-9]+$") | m.rlike(
            "[a-z].*[A-Z].*[0-9]|[0-9].*[a-z].*[A-Z]"))
    elif kind == "national":
        check = digits == 10
    elif kind == "email":
        check = m.rlike(r"\.[A-Za-z]{2,24}$")
    else:
        check = base_valid(kind, m)
    before = F.lower(tail)
    left, right = ~tail.rlike("[A-Za-z0-9]$"), ~head.rlike("^[A-Za-z0-9]")
    word = before.rlike(SPEAKS[kind])
    if kind == "secret":
        word = word | m.startswith("AKIA")
    rich = F.size(F.array_distinct(F.split(m, ""))) >= 6
    vote = lambda yes: F.when(yes, 1).otherwise(-1)
    size = F.length(m)
    return {
        "v_regex": vote(check), "v_gazetteer": F.when(word, 1).when(before.rlike(AGAINST), -1).otherwise(0),
        "v_context": vote(left & right), "v_shape": vote(rich),
        "f_check": check.cast("int"), "f_left": left.cast("int"), "f_right": right.cast("int"),
        "f_word": word.cast("int"), "f_rich": rich.cast("int"),
        "f_len": F.when(size < 10, 0).when(size < 16, 1).when(size < 24, 2).otherwise(3),
        "f_digits": F.when(digits * 5 < size, 0).when(digits * 5 < 3 * size, 1).otherwise(2),
    }


def _found(docs: DataFrame) -> DataFrame:
    """Adds, by kind, the matches ``_m_kind`` and the pieces between them, ``_p_kind``."""
    d = docs.withColumns({"_at": F.contains("text", F.lit("@")), "_dig": F.col("text").rlike("[0-9]")})
    none = F.array().cast("array<string>")
    flag = lambda k: F.col("_at" if NEEDS[k] == "@" else "_dig")
    d = d.withColumns({f"_m_{k}": F.when(flag(k), F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none)
                       for k in KINDS})
    return d.withColumns({f"_p_{k}": F.when(F.size(f"_m_{k}") > 0, F.split("text", PATTERNS[k], -1)).otherwise(none)
                          for k in KINDS}).drop("_at", "_dig")


def candidates(docs: DataFrame) -> DataFrame:
    """A row per candidate (and one, with kind NULL, per document): place, base check, signals.

    Places come from the lengths of the pieces and matches before, summed in a window over the
    document's candidates: small rows, however long the text. The matched text is not kept.
    """
    d = _found(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                           F.monotonically_increasing_id().alias("row")))

    def rows(k: str) -> Column:
        pieces = F.col(f"_p_{k}")

        def one(m: Column, i: Column) -> Column:
            tail, head = F.right(F.get(pieces, i), F.lit(CONTEXT)), F.left(F.get(pieces, i + 1), F.lit(2))
            s = signals(k, m, tail, head)
            return F.struct(F.lit(KINDS.index(k)).alias("kind"), i.alias("i"), F.length(F.get(pieces, i)).alias("gap"),
                            F.length(m).alias("len"), F.coalesce(base_valid(k, m), F.lit(False)).alias("base"),
                            *[s[c].cast("int").alias(c) for c in LABELERS + FEATURES])

        return F.transform(f"_m_{k}", one)

    d = d.select("doc_id", "row", F.concat(*[rows(k) for k in KINDS]).alias("c"))
    d = d.select("doc_id", "row", F.explode_outer("c").alias("c")).select("doc_id", "row", "c.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    return d.withColumns({"end": end, "start": end - F.col("len")}).drop("gap", "len", "i")


def expectation_maximisation(table: list[dict]) -> list[float]:
    """P(personal) of each vote pattern; ``table`` has kind, the votes and n (at most 6 * 81 rows).

    One class prior per kind and, per labeler and class, the chances of its three votes;
    smoothed, started from labelers that are right four times in five.
    """
    votes = (-1, 0, 1)
    right = {1: {-1: 0.15, 0: 0.25, 1: 0.6}, 0: {-1: 0.6, 0: 0.25, 1: 0.15}}
    theta = {(x, y): dict(right[y]) for x in LABELERS for y in (0, 1)}
    prior = {r["kind"]: 0.5 for r in table}
    post = [0.5] * len(table)
    for _ in range(ROUNDS):
        for j, r in enumerate(table):
            odds = math.log(prior[r["kind"]] / (1 - prior[r["kind"]]))
            odds += sum(math.log(theta[x, 1][r[x]] / theta[x, 0][r[x]]) for x in LABELERS)
            post[j] = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
        for kind in prior:
            mine = [(r["n"], p) for r, p in zip(table, post, strict=True) if r["kind"] == kind]
            prior[kind] = (1 + sum(n * p for n, p in mine)) / (2 + sum(n for n, _ in mine))
        for x in LABELERS:
            for y in (0, 1):
                weight = {v: 10 * right[y][v] for v in votes}
                for r, p in zip(table, post, strict=True):
                    weight[r[x]] += r["n"] * (p if y else 1 - p)
                total = sum(weight.values())
                theta[x, y] = {v: weight[v] / total for v in votes}
    return post


def train(table: list[dict], soft: list[float]) -> dict[tuple[str, int], float]:
    """Weights of a logistic classifier on one-hot features, from counted patterns."""
    names = sorted({(c, r[c]) for r in table for c in ("kind", *FEATURES)})
    w = dict.fromkeys(names, 0.0)
    total = max(1, sum(r["n"] for r in table))
    for _ in range(STEPS):
        grad = {k: 1e-3 * v for k, v in w.items()}
        for r, y in zip(table, soft, strict=True):
            keys = [(c, r[c]) for c in ("kind", *FEATURES)]
            z = sum(w[k] for k in keys)
            e = r["n"] / total * (1 / (1 + math.exp(-max(-40.0, min(40.0, z)))) - y)
            for k in keys:
                grad[k] += e
        for k in w:
            w[k] -= 2.0 * grad[k]
    return w


def fit(found: DataFrame) -> dict[tuple[str, int], float]:
    """The span classifier, from the counts of vote and feature patterns (a bounded table)."""
    rows = [r.asDict() for r in found.where("kind is not null").groupBy("kind", *LABELERS, *FEATURES).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    by_votes: dict[tuple, int] = {}
    for r in rows:
        key = (r["kind"], *(r[x] for x in LABELERS))
        by_votes[key] = by_votes.get(key, 0) + r["n"]
    table = [dict(zip(("kind", *LABELERS, "n"), (*k, n), strict=True)) for k, n in sorted(by_votes.items())]
    post = {(r["kind"], *(r[x] for x in LABELERS)): p
            for r, p in zip(table, expectation_maximisation(table), strict=True)}
    return train(rows, [post[r["kind"], *(r[x] for x in LABELERS)] for r in rows])


def accepted(model: dict[tuple[str, int], float], value: dict[str, Column], base: Column) -> Column:
    """Whether a candidate is a span: by the base rule, or by the classifier."""
    score = F.lit(0.0)
    for c in ("kind", *FEATURES):
        here = F.lit(0.0)
        for (name, v), w in model.items():
            if name == c:
                here = F.when(value[c] == v, float(w)).otherwise(here)
        score = score + here
    return F.coalesce(base, F.lit(False)) | (score > 0 if model else F.lit(False))


def find(docs: DataFrame) -> DataFrame:
    """Per row: counts of base spans by kind, their digest, and all spans.

    Offsets are code points, the end exclusive. A span that the method adds is left out where
    it meets a base span; added phone numbers in national form count as kind phone. NULL and
    empty texts have no spans (the digest is that of an empty string); repeated rows are
    judged alike; an empty table gives an empty result.
    """
    found = written(candidates(docs))
    model = fit(found)
    span = found.withColumn("ok", accepted(model, {c: F.col(c) for c in ("kind", *FEATURES)}, F.col("base")))
    by_start = Window.partitionBy("row").orderBy("start")
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    nxt = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    free = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(nxt, F.col("end")) >= F.col("end"))
    span = span.withColumn("ok", F.col("kind").isNotNull() & (F.col("base") | (F.col("ok") & free)))
    shown = [k if k != "national" else "phone" for k in KINDS]
    order = [KINDS.index(k) for k in shown]
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("kind"))
    item = F.struct(pick(order).alias("kind"), F.col("start"), F.col("end"), F.concat_ws(
        ":", pick(shown), F.col("start"), F.col("end")).alias("text"))
    listed = lambda which: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(which, item))), lambda s: s["text"]), ",")
    count = lambda k: F.count(F.when(F.col("base") & (F.col("kind") == KINDS.index(k)), 1)).alias(f"n_{k}")
    return span.groupBy("row", "doc_id").agg(
        *[count(k) for k in BASE], F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("ok")).alias("spans")).drop("row")


def _running(values: Column, op) -> Column:
    """Running results of ``op`` over an array of ints >= 0 (sums, greatest), by doubling: n log n steps."""
    n = F.size(values)
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(n + F.lit(1))).cast("int")), lambda r: F.pow(2, r).cast("int"))

    def step(so_far: Column, far: Column) -> Column:
        back = F.slice(so_far, 1, F.greatest(n - far, F.lit(0)))
        return F.zip_with(so_far, F.concat(F.array_repeat(F.lit(0), F.least(far, n)), back), op)

    return F.aggregate(steps, values, step)


def _spans(kind: str, model: dict) -> Column:
    """The accepted matches of a kind on the whole text: start, end (exclusive), kind, sorted."""
    m, p = F.col(f"_m_{kind}"), F.col(f"_p_{kind}")

    def judge(x: Column, i: Column) -> Column:
        tail, head = F.right(F.get(p, i), F.lit(CONTEXT)), F.left(F.get(p, i + 1), F.lit(2))
        value = {"kind": F.lit(KINDS.index(kind)), **signals(kind, x, tail, head)}
        return F.struct(F.length(x).alias("len"), accepted(model, value, base_valid(kind, x)).alias("ok"))

    ends = _running(F.transform(m, lambda x, i: F.length(F.get(p, i)) + F.length(x)), lambda a, b: a + b)
    all_ = F.zip_with(ends, F.transform(m, judge), lambda end, j: F.struct(
        (end - j["len"]).alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"), j["ok"].alias("ok")))
    return F.filter(all_, lambda s: s["ok"])


def _cut(start: Column, end: Column) -> Column:
    """The characters from start to end of the text in ``_blocks``, without a walk from its beginning."""
    first = F.floor(start / F.lit(BLOCK)).cast("int")
    piece = F.array_join(F.slice("_blocks", first + 1, F.ceil(end / F.lit(BLOCK)).cast("int") - first), "")
    return F.substring(piece, start - first * BLOCK + 1, end - start)


def mask(docs: DataFrame) -> DataFrame:
    """The rows with each span replaced by its kind in angle brackets; other columns as they are.

    All spans are decided on the original text, as in ``find``; spans that overlap become one,
    from the first start to the last end, named after its longest (of equal ones the first
    kind), and all are replaced at once. An accepted span that meets a base span, which
    ``find`` leaves out, is masked with it: nothing that was accepted stays in the text. Texts
    stay where they are: nothing is shuffled but the candidates' pattern counts. NULL stays
    NULL.
    """
    model = fit(candidates(docs))
    columns = docs.columns
    d = _found(docs.select(F.struct("*").alias("_row"), "text"))
    d = d.select("_row", "text", F.sort_array(F.concat(*[_spans(k, model) for k in KINDS])).alias("_s"))
    # The columns below are each used more than once, so that Spark computes them once per row.
    d = d.withColumn("_r", _running(F.transform("_s", lambda s: s["end"]), lambda a, b: F.greatest(a, b)))
    d = d.withColumn("_b", F.filter(F.transform("_s", lambda s, i: F.when(
        (i == 0) | (s["start"] >= F.get("_r", i - 1)), i)), lambda b: b.isNotNull()))

    def union(b: Column, j: Column) -> Column:
        after = F.coalesce(F.get("_b", j + 1), F.size("_s"))
        longest = F.array_max(F.transform(F.slice("_s", b + 1, after - b), lambda s: F.struct(
            (s["end"] - s["start"]).alias("len"), (-s["kind"]).alias("kind"))))
        return F.struct(F.get("_s", b)["start"].alias("start"), F.get("_r", after - 1).alias("end"),
                        (-longest["kind"]).alias("kind"))

    d = d.select("_row", "text", F.transform("_b", union).alias("_u"), F.when(
        F.size("_s") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))).alias("_blocks"))
    names = F.array(*[F.lit(f"<{'PHONE' if k == 'national' else k.upper()}>") for k in KINDS])

    def put(u: Column, j: Column) -> Column:
        return F.concat(_cut(F.coalesce(F.get("_u", j - 1)["end"], F.lit(0)), u["start"]), F.get(names, u["kind"]))

    masked = F.concat(F.array_join(F.transform("_u", put), ""), _cut(F.element_at("_u", -1)["end"], F.length("text")))
    d = d.withColumn("text", F.when(F.size("_u") > 0, masked).otherwise(F.col("text")))
    return d.select(*[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in columns])
