import random

import pytest

from qanat.llm.packing import Tournament, count_tokens, first_fit_decreasing, pack, parts
from qanat.llm.splitting import cut_ends, cut_penalties, oversized_pieces, split_text


def check(text, limit, overlap):
    pieces, words = split_text(text, limit, overlap), text.split()
    at = 0
    for i, (first, n, piece) in enumerate(pieces):
        assert n <= limit and piece.split() == words[first : first + n]
        assert first == (at - overlap if i else 0)
        at = first + n
    assert at == len(words)
    return pieces


@pytest.mark.parametrize("n", [0, 1, 20, 21, 35, 36, 100, 999])
def test_rules_hold(n):
    rng = random.Random(n)
    text = " ".join(rng.choice(["word", "end.", "part,", "last.\n\n", "x\n"]) for _ in range(n))
    pieces = check(text, 20, 5)
    assert (len(pieces) > 1) == (n > 20)


def test_cuts_at_paragraphs():
    text = "\n\n".join(" ".join(["w"] * 15) for _ in range(3))
    assert [first + n for first, n, _ in check(text, 20, 5)][0] == 15


def test_invisible_characters_belong_to_tokens():
    assert len(split_text(" ".join(["a\u200bb"] * 600))) == 2
    assert split_text(" ".join(["a"] * 512))[0][1] == 512
    assert split_text("   ") == [] and split_text("") == []


def test_best_cost_by_brute_force():
    rng = random.Random(5)
    text = " ".join(rng.choice(["a", "b.", "c,"]) for _ in range(24))
    spans_penalties = cut_penalties(text, [(i, i + len(w)) for w, i in _places(text)])
    ends = cut_ends(spans_penalties, 10, 3)
    best = min(_ways(24, 10, 3), key=lambda e: _cost(e, spans_penalties, 10, 3))
    assert abs(_cost(ends, spans_penalties, 10, 3) - _cost(best, spans_penalties, 10, 3)) < 1e-9


def _places(text):
    at = 0
    for w in text.split():
        at = text.index(w, at)
        yield w, at
        at += len(w)


def _ways(n, limit, overlap):
    todo = [[e] for e in range(overlap + 1, limit + 1)]
    while todo:
        ends = todo.pop()
        if ends[-1] == n:
            yield ends
        todo += [[*ends, e] for e in range(ends[-1] + 1, min(n, ends[-1] + limit - overlap) + 1)]


def _cost(ends, penalties, limit, overlap):
    n = len(penalties)
    fewest = -(-(n - overlap) // (limit - overlap))
    ideal = (n + overlap * (fewest - 1)) / fewest
    starts = [0, *(e - overlap for e in ends[:-1])]
    return sum(penalties[e - 1] + 6.0 * ((e - s - ideal) / ideal) ** 2 for s, e in zip(starts, ends))


def test_oversized_records(spark):
    rows = [("a", "1", " ".join(["x"] * 513)), ("a", "2", " ".join(["x"] * 512)), ("a", "3", None), ("a", "4", ""), ("b", "1", " " + "y " * 2000), ("b", "2", "z" * 5000)]
    got = oversized_pieces(spark.createDataFrame([(*r, 1) for r in rows], "record_table string, record_id string, text string, pieces int")).collect()
    assert {(r["record_table"], r["record_id"]) for r in got} == {("a", "1"), ("b", "1")}
    assert all(r["n_tokens"] <= 512 for r in got)
    with pytest.raises(ValueError):
        split_text("a", 5, 5)


def test_first_fit_is_first_fit():
    rng = random.Random(1)
    sizes = [rng.randint(0, 40) for _ in range(300)]
    free, wanted = [], {}
    for i in sorted(range(300), key=lambda i: -sizes[i]):
        b = next((b for b, f in enumerate(free) if f >= sizes[i]), len(free))
        if b == len(free):
            free.append(50)
        free[b] -= sizes[i]
        wanted[i] = b
    assert first_fit_decreasing(sizes, 50) == [wanted[i] for i in range(300)]
    tree = Tournament(10, 1)
    assert tree.place(10) == 0
    with pytest.raises(ValueError):
        tree.place(1)
    assert parts(0, 10) == [0] and parts(10, 10) == [10] and parts(25, 10) == [10, 10, 5]


def test_pack(spark):
    texts = [(i, "word " * n, "x") for i, n in enumerate([5, 90, 40, 60, 250, 0])] + [(7, None, "x"), (1, "word " * 90, "x")]
    frame = spark.createDataFrame(texts, "id long, text string, part_index string")
    got = pack(frame, "id", "text", capacity=100, group_items=3).toPandas()
    assert got.groupby("container_id")["n_tokens"].sum().max() <= 100
    sizes = dict(zip((t[0] for t in texts), count_tokens([t[1] for t in texts])))
    assert got[got["item_id"] != 1].groupby("item_id")["n_tokens"].sum().to_dict() == {i: n for i, n in sizes.items() if i != 1}
    assert got[got["item_id"] == 1]["n_tokens"].sum() == 2 * sizes[1]
    assert (got[got["item_id"] != 4].groupby("item_id").size().drop(1) == 1).all()
    assert pack(frame.limit(0), "id", "text").count() == 0
