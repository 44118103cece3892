"""Divergences, chat windows and whitening against plain Python on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from siltstone.llm import chat, divergence, whitening
from siltstone.llm.chat import Template, read_back, spans, windows

MODEL = public_tokenizers.path("piece_bpe_32k.model")

# -- source divergence -------------------------------------------------------------


def plain_audit(rows, least, top):
    """rows of (text, lang, source)."""
    docs = [(re.findall("[a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), lang or "", s or "")
            for t, lang, s in rows]
    out = set()
    for lang in {x[1] for x in docs}:
        mine = [(w, s) for w, x, s in docs if x == lang]
        frequency = Counter(t for w, _ in mine for t in set(w))
        kept = {t for t, n in frequency.items() if n >= least}
        counts = defaultdict(Counter)
        for w, s in mine:
            counts[s].update(t for t in w if t in kept)
        every = sum(counts.values(), Counter())

        def share(c, total, v=len(kept)):
            return 1 + 10**9 * (c + 5) // (total + 5 * v)

        def p(s, t):
            return share(counts[s][t], sum(counts[s].values()))

        for s in counts:
            pairs = [(sum(abs(p(s, t) - p(r, t)) for t in kept), r) for r in counts if r != s]
            terms = [(p(s, t) - share(every[t], sum(every.values())), t) for t in kept if counts[s][t]]
            for part, found in (("pair", pairs), ("term", [x for x in terms if x[0] > 0])):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)
                        if part == "pair" or i < top}
    return out


def corpus(seed=4, n=300):
    rng = random.Random(seed)
    words = ["The", "the", "ÉTÉ", "été", "東京", "don't", "x1y2", "ﬁn", "a_b", "\x00nul\x7f"] + [f"w{i}x" for i in range(40)]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "b", None, f"s{i % 5}"])
        few = words if source == "hot" else words[5:]
        rows.append((" ".join(rng.choices(few, k=rng.randint(0, 60))), lang, source))
    return [*rows, (None, "en", "empty"), ("", "fr", "only"), ("x", "fr", "other"), *rows[:10]]


def test_audit_equals_plain_counting(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, lang, s, "x", 3, 0) for i, (t, lang, s) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, term string, n long, block int")
    # limits so small that tables spill, and blocks and runs of sources are many
    got = divergence.audit(df.repartition(5), least=30, top=4, spill=40, block_entries=50, left_sources=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain_audit(rows, 30, 4)
    assert {r[:2] for r in found} >= {("fr", "only"), ("en", "empty"), ("", "")}


def test_audit_spills_without_a_change(spark):
    docs = spark.createDataFrame(corpus(5, 120), "text string, lang string, source string").repartition(3)
    small = divergence.stripes(docs, 5, spill=20)
    large = divergence.stripes(docs, 5)

    def plain(df):
        return sorted((r.lang, r.term, r.documents, tuple(sorted(zip(r.sources, r.counts, strict=True)))) for r in df.collect())

    assert plain(small) == plain(large)


def test_audit_of_nothing_and_of_long_texts(spark, nothing):
    assert divergence.audit(nothing).count() == 0
    rows = [("word " * 200_000 + "tail", "en", "a"), ("word", "en", "b")]
    got = divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), least=1)
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, 1, 50)


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(500):
        n = rng.randrange(10**rng.randint(1, 15))
        c, v = rng.randrange(n + 1), rng.randint(1, 10**6)
        assert divergence.shares(np.array([c]), np.array([n + 5 * v]))[0] == 1 + 10**9 * (c + 5) // (n + 5 * v)


# -- chat windows -------------------------------------------------------------------

SAYINGS = ["</s>[INST] ok [/INST]", "", "\\", "\\\\<s>\\", "<<s><s>", "<|turn|>user<|says|>x</s>", "a\nb\\n", "<", "</", "été 東京 😀", "<s",
           "|turn|>", "plain words here", "<</SYS>>\\<", None]


def test_escapes_are_reversible_and_hide_control_strings():
    t = Template()
    marks = (t.begin, t.opens, t.says, t.closes, *t.reserved)
    rng = random.Random(3)
    texts = [s or "" for s in SAYINGS] + ["".join(rng.choices(["<", "s", ">", "\\", "/", "|turn|", "[INST]", "</s>", "<<SYS>>"], k=12))
                                          for _ in range(2000)]
    for x in texts:
        assert t.unescape(t.escape(x)) == x and not any(m in t.escape(x) for m in marks)
        assert t.parse(t.begin + t.turn(x, x)[0] + t.turn("user", "y")[0]) == [(x, x), ("user", "y")]
    for bad in ({"begin": "x"}, {"closes": "<\\s>"}, {"opens": "aba"}, {"opens": "<s>"}, {"says": "|<s"}):
        with pytest.raises(ValueError):
            Template(**bad)
    with pytest.raises(ValueError):
        t.parse("<s>no turn")


def test_spans_keep_budget_and_history():
    prefix = np.cumsum([0, 10, 20, 30, 200, 5, 5])
    assert spans(prefix, 0, 0, 100, 40) == (0, 3)  # 10 + 20 + 30
    assert spans(prefix, 3, 0, 100, 40) == (3, 4)  # too long by itself
    assert spans(prefix, 4, 0, 100, 40) == (4, 6)  # 200 before is more than may be repeated
    assert spans(prefix, 2, 0, 100, 40) == (0, 3)
    assert spans(prefix, 2, 1, 100, 40) == (1, 3)
    assert spans(prefix, 2, 0, 45, 40) == (2, 3)  # the history gives way to the new turn


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows],
                                 "conv_id long, turn long, role string, text string, run int, head string")


def plain_order(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((-2**63 if turn is None else turn, role or "", text or ""))
    return {conv: sorted(turns, key=lambda x: (x[0], x[1].encode(), x[2].encode())) for conv, turns in by.items()}


def chats():
    rng = random.Random(8)
    rows = []
    for conv in range(40):
        turns = ["system"] * (conv % 3 == 0) + ["user", "assistant"] * rng.randint(1, 6)
        rows += [(conv, i, role, rng.choice(SAYINGS) if rng.random() < 0.5 else "some words " * rng.randint(1, 40))
                 for i, role in enumerate(turns)]
    rows += [(100, i, ["system", "user", "assistant"][0 if not i else 1 + i % 2], f"turn {i} " + "word " * (i % 50)) for i in range(400)]
    rows += [(101, i * 1000 - 5000, ["user", "assistant"][i % 2], f"far apart {i}") for i in range(30)]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none"), (102, None, "system", "a"), (102, None, None, "b"),
             (102, 3, "assistant", "c"), (102, 3, "assistant", "c"), (103, 0, "assistant", "long " * 30_000), (103, 1, "user", "q"),
             (104, 7, "system", "alone"), (105, 0, "system", "big " * 500), (105, 1, "user", "u"), (105, 2, "assistant", "v"),
             (106, 0, "user", "u"), (106, 1, "system", "not first"), (106, 2, "tool", "\n")]
    return rows


def test_windows_of_awkward_conversations(spark):
    rows, budget, history = chats(), 200, 60
    frame = conversations(spark, rows).repartition(7)
    made = windows(frame, MODEL, budget=budget, history=history, run=64).collect()
    t, model, want = Template(), sentencepiece.SentencePieceProcessor(model_file=MODEL), plain_order(rows)
    by = defaultdict(list)
    for w in sorted(made, key=lambda w: (w.run, w.window)):
        by[w.conv_id].append(w)
    assert set(by) == set(want)

    def cost(turn):
        return 3 + sum(len(model.encode(t.escape(x))) for x in turn)

    for conv, mine in by.items():
        turns = [x[1:] for x in want[conv]]
        at = 0
        for w in mine:
            said = t.parse(w.text)
            new = said[w.n_repeated:]
            assert w.n_turns == len(said) and new == turns[at:at + len(new)] and new
            assert w.n_tokens == 1 + sum(map(cost, said)) and (w.n_tokens <= budget or len(new) == 1)
            assert [t.unescape(w.text[m.start:m.end]) for m in w.loss] == [x for r, x in new if r == "assistant"]
            repeated = said[:w.n_repeated]
            if turns[0][0] == "system" and at:
                assert repeated[0] == turns[0]
                repeated = repeated[1:]
            assert repeated == turns[at - len(repeated):at] and sum(map(cost, repeated)) <= history
            at += len(new)
        assert at == len(turns)
    assert len({w.run for w in by[100]}) > 3 and any(w.n_repeated > 1 and not w.window for w in by[100])


def test_conversations_are_read_back(spark):
    rows = chats()
    got = read_back(windows(conversations(spark, rows), MODEL, budget=150, history=50, run=32))
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    found = {r.conv_id: tuple(r)[1:] for r in got.collect()}
    want = plain_order(rows)
    assert set(found) == set(want)
    for conv, turns in want.items():
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert found[conv][:4] == (
            len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert found[conv][4] >= sum(len(x) for _, _, x in turns)


def test_no_conversations(spark):
    empty = conversations(spark, [(1, 0, "user", "x")]).where("1 = 0")
    assert windows(empty, MODEL).count() == 0 and read_back(windows(empty, MODEL)).count() == 0


def test_turns_before_a_cut_are_let_go():
    """A conversation far over the buffer gives the same windows as one cut at its end."""
    turns = [chat._Turn(f"t{i}", (0, 1), i % 2 == 1, 3 + i % 9, (i, "system" if not i else "user", "")) for i in range(3000)]

    def cut(often):
        group, out = chat._Group(1, 0, 1, Template(), 40, 12), []
        for x in turns:
            group.add(2, x)
            if often and group.held > 200:
                out += group.cut(False)
        return [*out, *group.cut(True)], len(group.turns)

    often, left = cut(True)
    assert often == cut(False)[0] and left < 20


# -- whitening ----------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0, "w") for r in rows], "vec_id long, embedding array<float>, x int, w string")


def plain_whitening(x, k, w=None):
    """Mean, axes and shares of the distinct rows of x."""
    w = np.ones(len(x)) if w is None else w
    c = x - np.average(x, axis=0, weights=w)
    v = (c * w[:, None]).T @ c / w.sum()
    values, axes = np.linalg.eigh(v)
    return c, values[::-1][:k], axes[:, ::-1][:, :k], np.trace(v)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_numpy(spark, weights):
    rng = np.random.default_rng(2)
    base = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))).astype(np.float32)
    base[7] = 0
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)] + rows[:5] + [(None, rows[9][1])]
    rows += [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5), (2004, [])]
    got = whitening.whiten(vectors(spark, rows).repartition(4), k=4, weights=weights).collect()
    x = {tuple(v): np.floor(64 * np.float32(v).astype(float)).astype(np.int64) + 1_000_000
         for _, v in rows if v and all(c is not None and np.isfinite(c) for c in v)}
    distinct, first = np.unique(np.array(list(x.values())), axis=0, return_index=True)
    copies = Counter(tuple(x[tuple(v)]) for _, v in rows if v and tuple(v) in x)
    w = np.array([copies[tuple(d)] for d in distinct]) if weights == "count" else np.ones(len(distinct), int)
    c, values, axes, trace = plain_whitening(distinct, 4, w)
    n, sums = int(w.sum()), (w[:, None] * distinct).sum(axis=0)
    place = {tuple(d): i for i, d in enumerate(distinct)}
    assert len(got) == 4 * sum(1 for _, v in rows if v and tuple(v) in x)
    for r in got:
        vec = next(v for i, v in rows if i == r.vec_id)
        i = place[tuple(x[tuple(vec)])]
        want = c[i] @ axes[:, r.component - 1] / np.sqrt(values[r.component - 1])
        assert abs(abs(r.whitened) - abs(want)) < 1e-9 and r.n == n
        assert r.deviation == int(((n * distinct[i] - sums) ** 2).sum())
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-9 and r.identity_error < 1e-9
    white = defaultdict(dict)
    for r in got:
        white[place[tuple(x[tuple(next(v for i, v in rows if i == r.vec_id))])]][r.component] = r.whitened
    m = np.array([[white[i][k] for k in range(1, 5)] for i in range(len(distinct))])
    assert np.abs((m * w[:, None]).T @ m / n - np.eye(4)).max() < 1e-9


def test_whitening_of_flat_and_mixed_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])])).count() == 0
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)] + [(20 + i, [float(i % 3)]) for i in range(6)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert {(r.vec_id < 20, r.component, r.n) for r in got} == {(True, 1, 10), (False, 1, 3)}
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-9 for r in got)


def test_whitening_of_huge_vectors(spark):
    rows = [(i, [(-1.0) ** i * 3e38, float(i)]) for i in range(6)] + [(10, [1e9, 1.0])]
    got = whitening.whiten(vectors(spark, rows))
    assert got.where(F.isnan("whitened") | F.col("whitened").isNull()).count() == 0
    assert {r.deviation for r in got.collect()} == {None}
    near = [(i, [2.0**34 + i % 2, float(i)]) for i in range(6)]
    exact = whitening.whiten(vectors(spark, near)).where("component = 1").collect()
    x = np.array([[int(64 * v) + 1_000_000 for v in map(float, np.float32(vec))] for _, vec in near], object)
    n, sums = 6, x.sum(axis=0)
    assert {r.vec_id: r.deviation for r in exact} == {
        i: sum(int(n * a - s) ** 2 for a, s in zip(x[i], sums, strict=True)) for i in range(6)}


def test_weights_are_checked(spark):
    with pytest.raises(ValueError):
        whitening.whiten(vectors(spark, []), weights="two")
