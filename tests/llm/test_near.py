"""The pipeline's near-duplicate stage against brute force at a Jaccard similarity of 0.8 over five words."""

from __future__ import annotations

import random

import corpus_pipeline
from tidewire.llm import near


def brute_kept(rows):
    """Keys kept: the smallest of each group that pairs with similarity 0.8 or more link."""
    sets = [frozenset(near.shingles(t).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] == sets[j] or shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        k = find(i)
        least[k] = min(least.get(k, (True, 0)), (key is None, key or 0))
    return sorted(v if not none else -1 for none, v in least.values())


def prose(r, n):
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def changed(r, words, n):
    words = list(words)
    for at in r.sample(range(len(words)), n):
        words[at] = f"c{r.randrange(10**9)}"
    return words


def test_near_duplicates_stage(spark):
    r = random.Random(3)
    texts = [None, "", " \n", "one", "ONE", "one two", "x " * 60]
    for k in range(40):
        base = prose(r, 300)
        texts += [" ".join(base), " ".join(changed(r, base, 1 + k % 9)), " ".join(changed(r, base, 30))]
    chain = prose(r, 400)
    for _ in range(6):  # neighbours are similar, the ends are not
        texts.append(" ".join(chain))
        chain = changed(r, chain, 6)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[10]), (None, "only here without a key"), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(-1 if x["doc_id"] is None else x["doc_id"] for x in corpus_pipeline.near_duplicates(spark, docs, "").select("doc_id").collect())
    assert got == brute_kept(rows)
    assert near.one_of_each(docs.limit(0)).count() == 0


def test_crowded_nodes(spark):
    """A large group of near copies, and as many texts that share a third with it but are no copies."""
    r = random.Random(4)
    base = prose(r, 300)
    texts = [" ".join(changed(r, base, 2)) for _ in range(300)] + [" ".join(base[:100] + prose(r, 200)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(x["doc_id"] for x in near.one_of_each(docs).select("doc_id").collect()) == [0, *range(300, 600)]


def test_fingerprints_are_simhash_of_the_set():
    r = random.Random(5)
    for n in (1, 4, 5, 60, 700):
        words = prose(r, n)
        found = near.shingles(" ".join(words)).tolist()
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))
        assert near.signature(near.shingles(" ".join(words)))[1] == want
    far = []
    for k in range(300):  # pairs at a similarity of 0.8 or little more
        own = [r.getrandbits(64) for _ in range((90, 9, 450)[k % 3])]
        cut = len(own) // 9
        a, b = (near.signature(near.np.array(sorted(x), near.np.uint64))[1] for x in (own[cut:] + [r.getrandbits(64) for _ in range(cut)], own))
        far.append((a ^ b).bit_count())
    assert max(far) <= near.RADIUS


def test_common_shingles_give_no_row_for_each_text(spark, monkeypatch):
    r = random.Random(6)
    base, rows = prose(r, 200), {}
    monkeypatch.setattr(near, "written", lambda df, name, real=near.written: rows.setdefault(name, real(df, name)))
    texts = {i: " ".join(changed(r, base, 2)) for i in range(400)} | {i: " ".join(prose(r, 30)) for i in range(400, 420)}
    texts |= {i: texts[400] + f" z{i}" for i in range(420, 430)}
    docs = spark.createDataFrame(list(texts.items()), "fp long, __text string")
    places = docs.selectExpr("fp as __fp", "fp div 400 as __node", "case when fp < 400 then 400 else 30 end as __members")
    got = sorted(map(tuple, near.rare_shingles(docs, places).collect()))
    sets = {i: near.shingles(t).view(near.np.int64).tolist() for i, t in texts.items()}
    n = near.np.unique(near.np.concatenate(list(map(near.np.array, sets.values()))), return_counts=True)
    few = {s for s, k in zip(n[0].tolist(), n[1].tolist(), strict=True) if k <= near.RARE}
    assert got == sorted((i, s) for i, x in sets.items() for s in x if s in few)
    assert rows["shingles"].count() < 2 * len(got) < sum(map(len, sets.values())) / 2


def test_pairs_that_the_index_misses_link(spark):
    """Pairs at exactly 0.8 with too few equal min-wise hashes (first two) or no node in common (the others)."""
    rows = []
    for k, seed in enumerate((24430, 48867, 24893, 27394, 58179)):
        r = random.Random(seed)
        words = [f"w{r.randrange(10**6)}" for _ in range(13)]
        pair = " ".join(words), " ".join([*words[:-1], "z"])
        (_, _, nodes, sketch), (_, _, others, other) = (near.signature(near.shingles(t)) for t in pair)
        parts = near.np.array([sketch], near.np.uint64) ^ near.np.array([other], near.np.uint64)
        assert not set(nodes[: len(near.VIEWS)]) & set(others[: len(near.VIEWS)]) if k > 1 else not near.alike(parts)[0]
        rows += [(3 * k, pair[0]), (3 * k + 1, pair[1]), (3 * k + 2, " ".join([*words[:-2], "y", "z"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_kept(rows)
    assert len(want) == 10  # the third text shares seven of eleven shingles, so it stays
    assert sorted(x["doc_id"] for x in near.one_of_each(docs).select("doc_id").collect()) == want


def test_open_pairs_need_no_index(spark, monkeypatch):
    """All similar pairs of different groups come from the shingles alone, through lists in many blocks and blocks in many batches, and few others."""
    monkeypatch.setattr(near, "CROWDED", 8)
    r = random.Random(8)
    base, line = prose(r, 120), prose(r, 12)
    texts = [None, "", "one", "ONE two", "one two three four five six", "one two three four five six seven"]
    texts += [" ".join(changed(r, base, k % 12)) for k in range(150)] + [" ".join(line + prose(r, k % 4)) for k in range(60)] + [" ".join(line + prose(r, 90)) for _ in range(40)]
    texts = list({near.shingles(t).tobytes(): t for t in texts}.values())
    sets = [frozenset(near.shingles(t).tolist()) for t in texts]
    shared = {(i, j): len(sets[i] & sets[j]) for j in range(len(sets)) for i in range(j)}
    similar = {(i, j) for (i, j), n in shared.items() if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n)}
    assert len(similar) > 200
    rows = [(i, (t,), i, len(sets[i]), near.parity(near.shingles(t)).view(near.np.int64).tolist()) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "fp long, __doc struct<text: string>, __row long, size long, parity array<long>")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 7)
        for group in (1, 3):  # a group each; three groups
            roots = df.selectExpr("fp as v", "fp as root" if group == 1 else "fp % 3 as root")
            got = [tuple(x) for x in near.open_pairs(df, df, "text", roots).collect()]
            want = {(i, j) for i, j in similar if group == 1 or i % 3 != j % 3}
            assert len(got) == len(set(got)) and want <= set(got) and all(i < j for i, j in got)
            assert len(got) < 2 * len(want) + 200
            assert group == 1 or all(i % 3 != j % 3 for i, j in got)
    finally:
        spark.conf.set(name, before)
