import random

import numpy as np

from pyspark.sql import functions as F

from qanat.llm.leakage import BUCKETS, REACHED, RUN, Beside, Space, calibrated_threshold, coded_texts, document_frequencies, fit_space, leaks, literal_leaks, longest_run, longest_subsequence, measured_recall, passages, run_keys, word_codes, words


def test_words_are_compared_without_dress():
    assert words("L'Affaire, «X»  —  نَصٌّ Ｖ") == ["laffaire", "x", "نص", "v"]
    assert words("") == [] and words(" . ") == []


def test_runs_and_subsequences():
    a, b = word_codes("a b c d e f"), word_codes("x b c d y f")
    assert longest_run(a, b) == 3 and longest_subsequence(a, b) == 4
    assert longest_run(a, a[:0]) == 0
    assert len(run_keys(a, 4)) == 3 and len(run_keys(a, 7)) == 0


def corpus(seed=1):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(150)]
    rare = [f"name{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(rare if rng.random() < 0.6 else common) for _ in range(60))) for i in range(30)]
    docs = []
    for d in range(300):
        text = [rng.choice(common) for _ in range(rng.randint(1, 150))]
        if d % 6 == 0:
            item = rng.choice(items)[1].split()
            n = rng.choice([8, 12, 13, 14, 30])
            at = rng.randrange(len(item) - n + 1)
            place = rng.randrange(len(text) + 1)
            text[place:place] = [w.upper() + "," for w in item[at : at + n]]
        docs.append((d, "\n".join(text)))
    docs += [(1000, docs[0][1]), (1001, None), (1002, ""), (1003, "x " * 20_000)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    runs = {i: set(run_keys(word_codes(t)).tolist()) for i, t in items}
    wanted = {(d, i) for d, t in docs if t for own in [set(run_keys(word_codes(t)).tolist())] for i in runs if own & runs[i]}
    frame = spark.createDataFrame([(*d, "x") for d in docs], "id long, text string, run string")
    held = spark.createDataFrame(items + [(99, None), (98, "too short"), items[0]], "id long, text string")
    got = {tuple(r) for r in literal_leaks(frame, held).collect()}
    assert got == wanted and wanted


def test_paraphrase_and_empty_tables(spark):
    item = "the trustee of alpha reclaimed bond seven before beta was heard near gamma harbour in late winter recess"
    close = "the trustee of alpha then reclaimed bond seven long before beta was heard near the gamma harbour in late deep winter recess"
    frame = spark.createDataFrame([(1, "some filler text about other things entirely. " + close), (2, "nothing of that kind here at all")], "id long, text string")
    held = spark.createDataFrame([(5, item)], "id long, text string")
    rows = leaks(frame, held).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows] == [(1, 5)] and rows[0]["run"] < 13 <= rows[0]["shared"]
    assert literal_leaks(frame.limit(0), held).count() == 0
    assert literal_leaks(frame, held.limit(0)).count() == 0
    assert np.isfinite(rows[0]["cosine"])


def test_literal_leaks_below_the_threshold_are_found(spark):
    rng = random.Random(4)
    common = [f"w{i}" for i in range(150)]
    items = [(i, " ".join(rng.choice(common) for _ in range(60))) for i in range(30)]
    docs = [(7000 + d, " ".join(rng.choice(common) for _ in range(100))) for d in range(1500)]
    for d, n in ((9000, 13), (9001, 12), (9002, 13)):  # beside words that stand nowhere else and weigh the most; none of them is a drawn filler
        rare = [f"rare{d}x{i}" for i in range(26)]
        docs.append((d, " ".join(rare[:13] + items[d % 30][1].split()[20 : 20 + n] + rare[13:])))
    frame, held = (spark.createDataFrame(x, "id long, text string") for x in (docs, items))
    assert {(r["doc_id"], r["item_id"]) for r in leaks(frame, held).collect() if r["run"] >= 13} == {(9000, 0), (9002, 2)}


def test_paraphrase_beside_a_nearer_passage(spark):
    rng = random.Random(6)
    item = "the trustee of alpha reclaimed bond seven before beta was heard near gamma harbour in late winter recess"
    close = "the trustee of alpha then reclaimed bond seven long before beta was heard near the gamma harbour"
    common = ["the", "then", "long", "deep", *(f"w{i}" for i in range(40))]
    some = lambda n: " ".join(rng.choice(common) for _ in range(n))
    topic = " ".join(item.split()[::-1])  # the item's words in another order: nearer than the paraphrase, but no subsequence
    docs = [(d, some(60)) for d in range(100)] + [(200, f"{topic} {some(8)} {some(26)} {close} {some(9)}"), (201, f"{topic} {some(40)}"), (202, f"{some(26)} {close} {some(9)}")]
    frame, held = spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame([(5, item)], "id long, text string")
    rows = {r["doc_id"]: r for r in leaks(frame, held).collect()}
    assert sorted(rows) == [200, 202]
    assert rows[200]["run"] < 13 <= rows[200]["shared"] == rows[202]["shared"]


def test_words_of_long_texts_count_once_a_block(spark):
    text = np.tile(np.arange(5, dtype=np.int64), 220_000)[: 1_100_000 - 3]
    words_, buckets, blocks = document_frequencies(spark.createDataFrame([(1, bytearray(text.tobytes()))], "id long, codes binary"), np.array([1, 3, 77]))
    assert blocks == -(-len(text) // 13) and set(buckets[:5].tolist()) <= {blocks - 1, blocks}
    assert words_[:2].tolist() == buckets[[1, 3]].tolist() and words_[2] == 0


def test_pruning_is_exact():
    rng = np.random.default_rng(5)
    vocabulary = np.sort(rng.integers(0, 1 << 40, 60))
    basis, _ = np.linalg.qr(rng.standard_normal((60, 16)))
    space = Space(vocabulary, rng.random(60).astype(np.float32), rng.random(BUCKETS).astype(np.float32), basis.astype(np.float32))
    texts = [rng.choice(np.concatenate([vocabulary, rng.integers(0, 1 << 40, 200)]), rng.integers(0, 90)) for _ in range(50)]
    owner, first, vectors, full = passages(texts, space)
    near = np.linalg.norm(vectors, axis=1) / full
    kept = set(zip(*(x.tolist() for x in passages(texts, space, 0.3)[:2])))
    assert {(o, f) for o, f, n in zip(owner.tolist(), first.tolist(), near) if n >= 0.3} <= kept and len(kept) < len(owner)


def test_templates_with_other_names_are_no_paraphrases(spark):
    rng = random.Random(8)
    form = "when a carrier near {} refused entry to {} the deputy {} ordered that the bond numbered {} be sealed and sent to {} at dawn"
    name = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    fill = lambda: form.format(name(), name(), name(), rng.randint(100, 9999), name())
    items = [(i, fill()) for i in range(20)]
    docs = [(d, " ".join(rng.choice(["the", "law", "of", "each", "file", f"word{rng.randint(0, 300)}"]) for _ in range(40))) for d in range(200)]
    docs += [(1000 + d, fill()) for d in range(40)]
    docs += [(2000 + i, t.replace("refused entry", "then denied any entry").replace("ordered that", "told them that").replace("sealed", "quickly sealed")) for i, t in items]
    frame, held = (spark.createDataFrame(x, "id long, text string") for x in (docs, items))
    got = {(r["doc_id"], r["item_id"]) for r in leaks(frame, held).collect() if r["run"] < 13}
    assert got <= {(2000 + i, i) for i, _ in items} and len(got) >= 18


def test_measured_recall(spark):
    docs, items = corpus(3)
    frame, held = (spark.createDataFrame(x, "id long, text string") for x in (docs, items))
    rows = {r["kind"]: r for r in measured_recall(frame, held).collect()}
    assert rows["literal"]["found"] == rows["literal"]["planted"] == 30 and rows["literal"]["retrieved"] >= 28
    assert rows["reworded"]["found"] <= rows["reworded"]["retrieved"] <= rows["reworded"]["planted"] == 30


def test_threshold_counts_every_run_beside_every_window(spark):
    rng = random.Random(11)
    common = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.8 else f"rare{d}x{k}" for k in range(rng.choice([0, 5, 13, 40]))) for d in range(60)]
    items = [word_codes(" ".join(rng.choice(common) if rng.random() < 0.5 else f"name{rng.randint(0, 40)}" for _ in range(n))) for n in (12, 13, 26, 27, 40)]
    codes = [word_codes(t) for t in texts]
    coded = coded_texts(spark.createDataFrame(list(enumerate(texts)), "id long, text string")).repartition(3)
    space = fit_space(coded, items, rank=8)
    item_of, _, latent, _ = passages(items, space)
    targets = latent / np.linalg.norm(latent, axis=1, keepdims=True)
    beside = Beside.of(coded, space, targets)
    around = [t[at : at + RUN] for t in codes if len(t) for at in range(max(1, len(t) - RUN + 1))]
    assert int(beside.counts.sum()) == len(around)
    cosines = []
    for i, item in enumerate(items):
        for at in range(len(item) - RUN + 1):
            _, _, vectors, length = passages([np.concatenate([item[at : at + RUN], w]) for w in around], space)
            cosines.append((vectors / length[:, None] @ targets[item_of == i].T).max(axis=1))
    threshold, exact = calibrated_threshold(space, items, beside), float(np.quantile(np.concatenate(cosines), 1 - REACHED))
    assert 0.7 * exact < threshold <= exact
    assert calibrated_threshold(space, items[:1], beside) == 1.0
    alone = calibrated_threshold(space, items, Beside.of(coded.limit(0), space, targets))
    assert threshold < alone < 1


def test_threshold_does_not_hang_on_a_part_of_the_texts(spark):
    rng = random.Random(12)
    common, names = [f"w{i}" for i in range(150)], [f"name{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(names) for _ in range(40))) for i in range(30)]
    order = [r["id"] for r in spark.range(2400).orderBy(F.xxhash64("id"), "id").collect()]  # the first 400 are of common words, all others of words that stand nowhere else
    docs = []
    for n, d in enumerate(order):
        text = [rng.choice(common) if n < 400 else f"rare{d}x{k}" for k in range(39)]
        if n < 400:
            text += [rng.choice(names) for _ in range(13)]
        if n >= 2340:
            text[13:13] = items[n % 30][1].split()[n % 27 :][:13]
        docs.append((d, " ".join(text)))
    frame, held = (spark.createDataFrame(x, "id long, text string") for x in (docs, items))
    rows = [r for r in leaks(frame, held).collect() if r["run"] >= 13]
    assert len({(r["doc_id"], r["item_id"]) for r in rows}) == len(rows) == 60
    assert sum(r["retrieved"] for r in rows) >= 58
