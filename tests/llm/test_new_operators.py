"""Operators 11 to 13 on small fixtures with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hydrocal.llm import chat_format, lexical_search, vector_codes


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])


# ---- 11: vector codes ----

VECTORS = "vec_id long, embedding array<double>, label string, code string, part int, `a.b` int"


def vectors():
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(32)] for _ in range(6)]
    out = []
    for i in range(400):
        c = centres[i % 6]
        out.append((i, [x + rng.gauss(0, 0.2) for x in c], None if i % 7 == 0 else f"l{i % 3}"))
    out += [(1000 + i, [0.5] * 32, "same") for i in range(30)]  # copies, and ties between entries
    out += [(5, [0.25] * 32, "l0"), (5, [0.125] * 32, None), (None, [-1.0] * 32, "l1"), (-7, [float(j % 3) for j in range(32)], "l2")]
    out += [(2000, None, "l0"), (2001, [], "l0"), (2002, [None] + [0.0] * 31, "l0"), (2003, [float("nan")] * 32, "l0"), (2004, [float("inf")] * 32, "l1"), (2005, [0.0] * 16, "l1"), (2006, [1e30] * 32, "l1")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS)


def brute_codes(rows, parts, entries, rounds, scale):
    kept = [r for r in rows if r[1] and len(r[1]) == 32 and all(x is not None and math.isfinite(x) and abs(x) < 2**18 for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[math.floor(scale * t) for t in r[1]] for r in kept], np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].copy()  # (entry, part, width)
    for turn in range(rounds + 1):
        d = ((x[:, None] - books[None]) ** 2).sum(3)  # row, entry, part
        code = d.argmin(1)
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books)):
                    mine = x[code[:, p] == e, p]
                    if len(mine):
                        books[e, p] = mine.sum(0) // len(mine)
    error = d.min(1).sum(1)
    of_label = defaultdict(int)
    for r, e in zip(kept, error.tolist()):
        of_label[r[2]] += e
    text = ",".join(str(t) for p in range(parts) for e in range(len(books)) for t in books[e, p].tolist())
    sha = hashlib.sha256(text.encode()).hexdigest()
    return [(r[0], "".join(f"{c:02x}" for c in code[i].tolist()), int(error[i]), of_label[r[2]], sha) for i, r in enumerate(kept)]


@pytest.mark.parametrize("parts,entries,rounds,scale", [(16, 64, 2, 256), (8, 24, 5, 1000), (4, 3, 3, 16), (16, 256, 1, 256), (2, 1, 2, 7)])
def test_codes_equal_full_search(spark, parts, entries, rounds, scale):
    log = []
    got = vector_codes.vector_codes(frame(spark, vectors()), parts, entries, rounds, scale, log=log).collect()
    assert ordered(got) == ordered(brute_codes(vectors(), parts, entries, rounds, scale))
    assert len(log) == rounds - 1
    for b, need in log:
        assert sum(need) == parts * len(got) and len(need) <= b + 2


def test_bounds_spare_most_distances_and_b_falls(spark):
    log = []
    vector_codes.vector_codes(frame(spark, vectors()), 16, 64, 6, 256, log=log).count()
    kept = [b for b, _ in log]
    assert kept == sorted(kept, reverse=True) and 8 <= kept[-1] < kept[0] == 16
    b, need = log[-1]
    looked = sum(n * (min(z, 64) if z <= b else 64) for z, n in enumerate(need))
    assert looked < 0.3 * 64 * sum(need)


def test_bounds_hold_after_any_move():
    rng = np.random.default_rng(3)
    for trial in range(60):
        k, w, n = int(rng.integers(2, 40)), int(rng.integers(1, 5)), 200
        entries = rng.integers(-9, 10, (k, w)).astype(np.int64)  # few values: many ties
        x = rng.integers(-9, 10, (n, w)).astype(np.int64)
        b = keep = max(1, k // 4)
        near, low, outer, own = vector_codes.measured(x, entries, keep)
        for _ in range(4):
            new = entries + rng.integers(-2, 3, entries.shape) * (rng.random((k, 1)) < 0.5)
            moved = vector_codes.root_above(((new - entries) ** 2).sum(1))
            entries, keep = new, max(1, min(b, int(rng.integers(1, b + 1))))
            near, low, outer, own, _ = vector_codes.reassigned(x, near, low, outer, entries, moved, keep)
            d = ((x[:, None] - entries) ** 2).sum(2)
            assert (near[:, 0] == d.argmin(1)).all() and (own == d.min(1)).all()
            exact = 16 * np.sqrt(d)
            assert (low <= np.take_along_axis(exact, near, 1) + 1e-6).all()
            rest = exact.copy()
            np.put_along_axis(rest, near, np.inf, 1)
            assert (outer <= rest.min(1) + 1e-6)[rest.min(1) < np.inf].all()
            b = keep


def test_roots_are_exact():
    d = np.concatenate([np.arange(5000), (np.arange(1, 3000) ** 2) * 4801, np.array([2**54 - 1, 2**54 - 2, 2**53 + 1])])
    for x, lo, hi in zip(d.tolist(), vector_codes.root_below(d).tolist(), vector_codes.root_above(d).tolist()):
        assert lo == math.isqrt(256 * x) and hi == lo + (lo * lo < 256 * x)


def test_label_errors_with_many_labels(spark, monkeypatch):
    want = ordered(brute_codes(vectors(), 16, 64, 2, 256))
    monkeypatch.setattr(vector_codes, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(vector_codes, "HOT_ROWS", 40)
    assert ordered(vector_codes.vector_codes(frame(spark, vectors())).collect()) == want


def test_codes_of_odd_tables(spark):
    assert vector_codes.vector_codes(frame(spark, [])).count() == 0
    assert vector_codes.vector_codes(frame(spark, [(1, None, "a"), (2, [], "a")])).count() == 0
    one = vector_codes.vector_codes(frame(spark, [(1, [0.1] * 16, None)])).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in one] == [(1, "00" * 16, 0, 0)]
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.vector_codes(frame(spark, [(1, [0.1] * 15, None)]))


# ---- 12: ranked search ----

DOCS = "doc_id long, text string, rank int, score long, `a.b` string"
ITEMS = "item_id long, text string, q int, terms string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def library():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 80)))) for i in range(700)]
    docs += [(700 + i, docs[0][1]) for i in range(60)]  # equal scores beyond k
    docs += [(900, None), (901, ""), (902, " .,;!"), (None, docs[1][1]), (None, "w3 w3 w59"), (3, "w59 w59"), (3, "w59 w59"), (904, "É" + "w1É_w2É 中"), (905, " ".join(rng.choices(words, k=40_000))), (906, "W1 w1 W-1")]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 25)))) for i in range(40)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "w59 w59 W59"), (53, "w58"), (None, "w7 é"), (None, "w8"), (54, "ÉW1É"), (55, "w0")]
    return docs, items


def brute_ranked(docs, items, k):
    counted = [(i, Counter(split(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    queries = defaultdict(set)
    for i, t in items:
        queries[i] |= set(split(t))
    out = []
    for item, ts in queries.items():
        found = []
        for doc, c, n in counted:
            m = 50 + 50 * n * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                found.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return out


def asked(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, 2, "x") for r in docs], DOCS).repartition(3)
    return lexical_search.ranked(d, spark.createDataFrame([(*r, 1, "x") for r in items], ITEMS), **options).collect()


@pytest.mark.parametrize("k", [1, 7, 50])
def test_ranks_equal_brute_force(spark, k):
    docs, items = library()
    assert ordered(asked(spark, docs, items, k=k)) == ordered(brute_ranked(docs, items, k))


def test_ranks_in_several_groups_blocks_and_pieces(spark, monkeypatch):
    docs, items = library()
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 64)
    assert ordered(asked(spark, docs, items, group=9)) == ordered(brute_ranked(docs, items, 50))
    text = docs[-2][1].encode()
    monkeypatch.setattr(lexical_search, "PIECE", 100)
    assert [t for part in lexical_search.terms(text) for t in part] == [t.encode() for t in split(text.decode())]


def test_ranks_of_empty_tables(spark):
    docs, items = library()
    assert asked(spark, [], items) == [] and asked(spark, docs, []) == [] and asked(spark, [], []) == []
    assert asked(spark, [(1, None)], [(1, "a")]) == [] and asked(spark, docs, [(1, None)]) == []


def a_block(rng, docs=4000, words=30):
    """A block in which two common terms never meet at their best."""
    text = [rng.choices(range(words), [1 / (i + 1) for i in range(words)], k=rng.randint(5, 60)) for _ in range(docs)]
    vocabulary = {str(i).encode(): i for i in range(words)}
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(docs), pa.int64()), "text": [" ".join(map(str, t)) for t in text]})
    blocks = pa.Table.from_batches(lexical_search.counted(vocabulary)([batch])).to_pylist()
    df = np.zeros(words, np.int64)
    for r in blocks:
        if r["term"] is not None:
            df[r["term"]] = r["df"]
    n, length = (sum(r[c] or 0 for r in blocks) for c in ("n_docs", "n_terms"))
    rows = pa.RecordBatch.from_pylist([r for r in blocks if r["ids"]], schema=lexical_search._BLOCKS).select(["ids", "sizes", "starts", "docs", "tfs"])
    pairs = [(a, b) for a in range(16) for b in range(a + 1, 16)]
    index = pa.Table.from_batches(lexical_search.indexed(lexical_search.Statistics(n, length, df), pairs, 50)([rows])).to_pylist()
    return [lexical_search.Block(r) for r in index if r["ids"]], {(r["a"], r["b"]): r["floor"] for r in index if r["floor"]}


def test_pair_bounds_skip_more_and_lose_nothing():
    rng = random.Random(1)
    (block,), floors = a_block(rng)
    plain, paired, whole = [], [], 0
    for _ in range(60):
        query = np.array(sorted(rng.sample(range(30), 8)), np.int64)
        score = np.zeros(len(block.ids), np.int64)
        for t in query.tolist():
            d, x = block.postings(t)
            score[d] += x
            whole += len(d)
        floor = int(np.sort(score)[-50])
        want = np.flatnonzero(score >= floor)
        for on, seen in ((False, plain), (True, paired)):
            docs, got = block.search(query, floor, on, seen)
            assert docs.tolist() == want.tolist() and got.tolist() == score[want].tolist()
        known = [f for (a, b), f in floors.items() if a in query and b in query]
        assert max(known, default=0) <= floor
    assert sum(paired) < 0.95 * sum(plain) and sum(paired) < 0.5 * whole


# ---- 13: chat formatting ----

TURNS = "conv_id long, turn long, role string, text string, segment int, `a.b` int"
HOSTILE = chat_format.HOSTILE


def conversations():
    rng = random.Random(6)
    bits = ["<", "|", "\\", "<|", "<|im_end|>", "<|im_start|>", "assistant", "\n", " ", "é", "中", "a", "<\\|", "<\\\\|im_end|>", "\x00"]
    out = [(c, t, ("user", "assistant")[t % 2], "".join(rng.choices(bits, k=rng.randint(0, 12)))) for c in range(40) for t in range(rng.randint(1, 6))]
    out += [(100, t, ("system", "user", "assistant", "tool")[t % 4], f"long {t} <|") for t in range(700) if t % 190 != 5]
    out += [(101, 0, "user", None), (101, 1, "assistant", None), (102, 0, "assistant", ""), (103, 0, "assistant", "x" * 300_000), (103, 1, "user", "<" * 5000)]
    out += [(104, 1, "user", "same")] * 3 + [(104, 1, "assistant", "same")] * 80 + [(104, None, "assistant", "last"), (104, -3, "assistant", "first")]
    out += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (105, 0, None, "no role"), (105, 1, "odd\nrole <|im_end|> \\n", "t"), (105, 2, "assistant", "z"), (106, 1 << 60, "assistant", "far"), (106, 3, "user", "near")]
    rng.shuffle(out)
    return out


def brute_digests(rows):
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is None, t or 0, r or "", x or ""))
    out = []
    for c, turns in groups.items():
        turns.sort()
        said = [x for _, _, r, x in turns if r == "assistant"]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), sum(map(len, said)), sha("".join(said))))
    return out


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS).repartition(3)


def test_files_read_back(spark, tmp_path):
    rows = conversations()
    chat_format.write_formatted(chats(spark, rows), f"{tmp_path}/a")
    got = chat_format.digests(spark.read.parquet(f"{tmp_path}/a")).collect()
    assert ordered(r[:5] for r in got) == ordered(brute_digests(rows))
    whole = {r.conv_id: r.formatted_chars for r in got}
    assert whole[103] == len(chat_format.chatml([("assistant", "x" * 300_000), ("user", "<" * 5000)]))
    parts = spark.read.parquet(f"{tmp_path}/a").collect()
    assert sum(r.conv_id == 100 for r in parts) == 11 and max(len(r.spans) for r in parts) <= 64
    assert not any(s.rewritten for r in parts for s in r.spans)
    turns = [(r, x) for _, r, x in sorted((t, r, x) for c, t, r, x in rows if c == 100)]
    text = "".join(r.text for r in sorted(parts, key=lambda r: (r.segment, r.piece)) if r.conv_id == 100)
    assert text == chat_format.chatml(turns) and chat_format.chatml_turns(text) == turns
    chat_format.write_formatted(chats(spark, []), f"{tmp_path}/b")
    assert chat_format.digests(spark.read.parquet(f"{tmp_path}/b")).count() == 0


def test_escape_is_reversible_and_hides_marks():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choices(["<", "|", "\\", "im_end|>", "\n", "a"], k=rng.randint(0, 9)))
        hidden = chat_format.escaped(text)
        assert "<|" not in hidden and chat_format.unescaped(hidden) == text
        assert chat_format.chatml_turns(chat_format.chatml([(text, text), ("u", text)])) == [(text, text), ("u", text)]
    with pytest.raises(ValueError, match="character 0"):
        chat_format.chatml_turns("plain")


def test_spans_of_black_boxes():
    turns = [("system", "be kind"), ("user", "hi <b>"), ("assistant", "a"), ("user", "b"), ("assistant", "bye b")]
    masked = frozenset(["assistant"])

    def first_only(ts):  # a beginning that only the first turn has, and a frame that depends on the role
        return "".join(("<s>" if i == 0 else "") + (f"[{r}]{t}[/]" if r == "user" else f" {t} </s>") for i, (r, t) in enumerate(ts))

    text, spans = chat_format.render(first_only, turns, masked)
    assert text == first_only(turns) and not any(s["rewritten"] for s in spans)
    assert [text[s["loss_start"] : s["loss_end"]] for s in spans if s["loss_start"] is not None] == ["a", "bye b"]
    assert "".join(text[s["start"] : s["end"]] for s in spans) == text

    def drops_thoughts(ts):  # earlier assistant turns are shortened once another turn follows
        return "".join(f"{r}:{t[:2] if i < len(ts) - 1 and r == 'assistant' else t};" for i, (r, t) in enumerate(ts))

    long = [("user", "q"), ("assistant", "thought"), ("user", "r"), ("assistant", "answer")]
    text, spans = chat_format.render(drops_thoughts, long, masked)
    assert [s["rewritten"] for s in spans] == [False, True, True, False]
    assert [text[s["loss_start"] : s["loss_end"]] for s in spans if s["loss_start"] is not None] == ["answer"]

    def counts(ts):  # the number of turns stands before all of them
        return f"{len(ts)}|" + "".join(t for _, t in ts)

    assert all(s["rewritten"] for s in chat_format.render(counts, long, masked)[1])
    upper = lambda ts: "".join(t.upper() + ";" for _, t in ts)  # noqa: E731  the text can be found, whatever became of it
    text, spans = chat_format.render(upper, long, masked)
    assert [text[s["loss_start"] : s["loss_end"]] for s in spans if s["loss_start"] is not None] == ["THOUGHT", "ANSWER"]


def test_a_template_that_looks_far_back_is_noticed(spark):
    def numbered(ts):
        return "".join(f"{i}:{t}\n" for i, (_, t) in enumerate(ts))

    rows = [(1, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(10)]
    got = chat_format.formatted(chats(spark, rows), template=numbered, segment=4).orderBy("segment").collect()
    flags = [s.rewritten for r in got for s in r.spans]
    assert flags[:4] == [False] * 4 and all(x for r in got[1:] for x in [s.rewritten for s in r.spans][1:])
    assert all(s.loss_start is None for r in got for s in r.spans if s.rewritten)


def test_links_of_segments(spark):
    rows = [(c, s, 10 * s) for c, all_ in ((1, [0, 1, 2, 4095, 4096, 4097, 9000, 20_000]), (2, [5]), (None, [0, 3])) for s in all_]
    got = chat_format.segment_links(spark.createDataFrame(rows, "conv_id long, segment long, turn long")).collect()
    one = [0, 1, 2, 4095, 4096, 4097, 9000, 20_000]
    assert ordered(got) == ordered([(1, a, 10 * a, b) for a, b in zip(one, one[1:])] + [(None, 0, 0, 3)])
