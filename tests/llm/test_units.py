"""Parts of the operators that need no Spark."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from kinweave.llm import counts, idfiles, jaccard, links, neighbours, packing, quality, sharding, tokens


def test_words_encode_as_the_library_does():
    e = tokens.Encoder(tokens.default_tokenizer())
    random.seed(1)
    letters = list(" \n\t\r\x0b\x0c\x1c\x85\xa0 ab1'sé.,日<|²½🙂")
    texts = ["", None, " ", "<|endoftext|> a", "a  b", "it's. The end.\n\nNew"] + ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    plain = e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for _ in range(2):  # with and without known words
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts, 2)] == [p.ids + [2] for p in plain]


def test_coded_bytes_are_those_of_earlier_files():
    i = np.arange(40_000, dtype=np.int64)
    ids = np.where(i % 11 < 4, i * i % 50_257, i % 7 * i % 97)
    ids[::5_000] = (1 << 20) - 2
    blocks = idfiles.compress(ids)
    assert (idfiles.expand(blocks) == ids).all()
    assert [len(blocks), zlib.crc32(b"".join(x for _, x in blocks))] == [20, 444567043]


@pytest.mark.parametrize("n", [0, 1, 2, idfiles.BLOCK - 1, idfiles.BLOCK, idfiles.BLOCK + 1, 3 * idfiles.BLOCK + 7])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 1 << 16, n), rng.zipf(1.3, n) % 50257, np.full(n, (1 << 20) - 2), np.tile([5, 6, 7], n)[:n], rng.integers(0, (1 << 20) - 1, n)):
        assert (idfiles.expand(idfiles.compress(ids.astype("<u4"))) == ids).all()


def test_coder_learns_and_takes_many_blocks(monkeypatch):
    monkeypatch.setattr(idfiles, "LANES", 3)
    ids = np.random.default_rng(3).zipf(1.5, 11 * idfiles.BLOCK + 5) % 50257
    blocks = idfiles.compress(ids)
    assert len(blocks) == 12 and (idfiles.expand(blocks) == ids).all()
    assert (idfiles.expand(blocks[4:6]) == ids[4 * idfiles.BLOCK : 6 * idfiles.BLOCK]).all()  # blocks stand alone
    once, twice = (sum(len(x) for _, x in idfiles.compress(np.tile(ids[:200], k))) for k in (1, 8))
    assert twice < 5 * once  # what repeats costs less
    with pytest.raises(ValueError):
        idfiles.compress(np.array([(1 << 20) - 1]))


def test_segments_keep_documents_and_find_damage():
    ids = np.r_[np.arange(3), np.full(3000, 9)].astype("<u4")
    data = idfiles.pack_segment([(7, 3), (None, 0), (-1, 3000)], ids)
    names, sizes, back = idfiles.unpack_segment(data)
    assert (names, sizes.tolist(), back) == ([7, None, -1], [3, 0, 3000], ids.tobytes())
    head = 24 + 13 * 3 + 12 * 2
    for at in [*range(head), *range(head, len(data), 29)]:
        bad = bytearray(data)
        bad[at] ^= 1 << at % 8
        try:
            got = idfiles.unpack_segment(bytes(bad))
        except ValueError:
            continue
        # the coder's last bytes may hold more bits than it needs
        assert at >= len(data) - 6 or at >= 24 and got[0] == names and got[2] == back, at
    with pytest.raises(ValueError):
        idfiles.unpack_segment(data[:-1])


def test_trie_counts_equal_plain_segmentation():
    t = counts.Trie(counts.default_vocabulary())

    def plain(w: bytes) -> float:
        best = [0.0] + [-1e300] * len(w)
        for i in range(1, len(w) + 1):
            for j in range(i):
                if w[j:i] in t.score:
                    best[i] = max(best[i], best[j] + t.score[w[j:i]])
        return best[-1]

    random.seed(2)
    for _ in range(200):
        w = "".join(random.choice("theanding ofé🙂") for _ in range(random.randint(1, 14))).encode()
        n = t._insert(w)
        node = 0
        for b in w:
            node = t.edges[node << 8 | b]
        assert abs(t.best[node] - plain(w)) < 1e-9 and 1 <= n <= len(w)
    assert t.count("") == (0, 0) and t.count("a a")[0] == 2


def test_best_fit_decreasing_and_bounds():
    rng = np.random.default_rng(5)
    for _ in range(60):
        size = rng.integers(1, 65, rng.integers(0, 60))
        bins, offsets, n = packing.best_fit_decreasing(size, 64)
        bound = packing.lower_bound(np.bincount(size, minlength=65), 64)
        assert -(-size.sum() // 64) <= bound <= n
        for b in range(n):
            own = np.argsort(offsets[bins == b])
            o, s = offsets[bins == b][own], size[bins == b][own]
            assert o.tolist() == np.r_[0, np.cumsum(s)[:-1]].tolist() and s.sum() <= 64
    assert packing.lower_bound(np.bincount([33] * 7, minlength=65), 64) == 7
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)] and packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)] and packing.cut(1, 1024) == [(0, 1)]


def test_room_tree_takes_the_tightest_bin():
    random.seed(4)
    tree, rooms = sharding.RoomTree(), []
    for i in range(500):
        if rooms and random.random() < 0.5:
            size = random.randint(0, 50)
            want = min((x for x in rooms if x[0] >= size), default=None)
            assert tree.take(size) == want
            if want:
                rooms.remove(want)
        else:
            rooms.append((random.randint(0, 50), i))
            tree.add(*rooms[-1])


def one_by_one(sizes, capacity):
    """Best-fit-decreasing, item after item: the rooms that are left."""
    rooms = []
    for x in sorted(sizes, reverse=True):
        fit = min((r for r in rooms if r >= x), default=None)
        if fit is None:
            rooms.append(capacity - x)
        else:
            rooms[rooms.index(fit)] -= x
    return sorted(rooms)


def loads(runs):
    out, ranks = Counter(), {}
    for r in runs:
        for i in range(r.shards):
            out[r.shard + i] += r.each * r.size
        ranks.setdefault(r.size, []).append((r.first, r.each * r.shards))
    for own in ranks.values():  # ranks are gapless
        own.sort()
        assert [x for x, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
    return out


def test_runs_equal_best_fit_one_by_one():
    rng = np.random.default_rng(21)
    for _ in range(300):
        capacity = int(rng.integers(10, 120))
        items = Counter(rng.integers(1, capacity + 1, rng.integers(0, 80)).tolist())
        runs = sharding.best_fit_decreasing(sorted(items.items(), reverse=True), capacity)
        assert Counter(capacity - x for x in one_by_one(items.elements(), capacity)) == Counter(loads(runs).values())
        for size, n in items.items():
            assert sum(r.each * r.shards for r in runs if r.size == size) == n


def test_even_and_fewest():
    assert sorted(loads(sharding.even([(100, 1), (5, 60)], 4)).values()) == [100, 100, 100, 100]
    assert sorted(loads(sharding.even([(100, 3), (5, 20)], 4)).values()) == [100, 100, 100, 100]
    assert len(loads(sharding.fewest([(6, 1), (5, 2), (4, 1)], 10))) == 2
    assert sorted(loads(sharding.fewest([(99, 12_000), (500, 2)], 234)).values()) == [198] * 6000 + [500] * 2
    assert sharding.even([], 3) == [] and sharding.fewest([], 3) == []
    rng = np.random.default_rng(22)
    sizes = Counter((16 + rng.zipf(1.6, 30_000) % 20_000).tolist())
    found = loads(sharding.even(list(sizes.items()), 40))
    assert len(found) == 40 and max(found.values()) <= 1.001 * min(found.values())


def test_union_and_leaves():
    u = links.Union()
    assert u.join(3, 2) and u.join(5, 3) and not u.join(2, 5) and u.find(5) == 2
    x = np.random.default_rng(0).standard_normal((2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = list(neighbours.leaves(x, 0.02, 1))
    assert set(np.concatenate(found)) == set(range(2000)) and max(map(len, found)) <= neighbours.LEAF
    same = np.repeat(x[:1], 600, 0)
    assert [len(i) for i in neighbours.leaves(same, 0.02, 1)] == [600]


@pytest.mark.parametrize("light", [0, 9, 13])
def test_similar_sets_share_a_key(light):
    """Every pair at the threshold or above has a common key, for small and large sets, equal and unequal sizes, rare and common shingles."""
    rng = np.random.default_rng(6)
    for num, den in ((85, 100), (80, 100)):
        rule = jaccard.Rule(num, den, light)
        common = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        sets, pairs = [], []
        for _ in range(700):
            p = int(rng.choice([rng.integers(1, 20), rng.integers(10, 60), rng.integers(60, 600)]))
            q = int(rng.choice(list(rule.partners(p))))
            need = rule.need(p, q)
            if need > min(p, q):
                continue
            pool = rng.permutation(np.unique(np.r_[rng.choice(common, min(p // 2, 300), False), rng.integers(0, 1 << 63, p + q).astype(np.uint64)]))[: p + q - need]
            if len(pool) < p + q - need:
                continue
            pairs.append(len(sets))
            sets += [np.unique(pool[:p]), np.unique(np.r_[pool[:need], pool[p:]])]
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, which, n = np.unique(flat, return_inverse=True, return_counts=True)
        length = n[which]
        sizes = np.array([len(s) for s in sets])[owner]
        shared = length > 1
        keys, nodes = rule.keys(owner[shared], sizes[shared], flat[shared], length[shared])
        for i in pairs:
            assert np.intersect1d(keys[nodes == i], keys[nodes == i + 1]).size, (len(sets[i]), len(sets[i + 1]))


def test_boundary_goes_by_cost():
    rule = jaccard.Rule(85, 100)
    assert rule.by_cost(1.0).light <= rule.by_cost(3.0).light <= rule.by_cost(50.0).light < 40
    own = rule.by_cost(20.0)
    assert own.subsets(own.light) <= own.rarest(own.light) * 20 < own.rarest(own.light + 1) * 20 < own.subsets(own.light + 1) + 20


def test_overlapping_equals_brute_force():
    rng = np.random.default_rng(7)
    rule = jaccard.Rule(1, 2)
    sets = [np.unique(rng.integers(0, 12, rng.integers(1, 9)).astype(np.uint64)) for _ in range(60)]
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if 2 * len(np.intersect1d(sets[i], sets[j])) >= len(np.union1d(sets[i], sets[j]))}
    assert {(i, int(j)) for i, js in jaccard.overlapping(sets, rule) for j in js} == want
    assert {(i, int(j)) for i, js in jaccard.overlapping(sets, rule, 25) for j in js} == {(i, j) for i, j in want if i < 25 <= j}


def test_repeated_words_and_trees():
    ws = b"a b c d e f g h x a b c d e f g h".split()
    assert quality.repeated([ws, ws[:8], [], b"z z z z z z z z z".split()]) == [16, 0, 0, 9]
    rng = np.random.default_rng(8)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.2 * rng.standard_normal(3000) < 0.5).astype(float)
    model = quality.train(x[:2000], y[:2000], np.array([-1, 0, 0]), trees=20)
    assert ((model.score(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.8  # held out
    line = np.stack([np.linspace(0, 1, 200), np.full(200, 0.5), np.full(200, 0.5)], 1)
    assert (np.diff(model.score(line)) <= 1e-12).all()


def test_cut_keeps_good_and_catches_junk():
    good, junk = np.linspace(-1, 3, 1000), np.linspace(-4, -0.5, 100)
    cut = quality.cut_of(good, junk, 0.001, 0.95)
    assert -1 < cut <= -0.6 and (junk < cut).mean() >= 0.9
    assert quality.cut_of(np.r_[good, [-9.0] * 5], junk, 0.001, 0.95) >= -0.8  # a few mislabelled ones don't open the door
    assert quality.cut_of(good + 2, junk, 0.001, 0.95) == 0 and quality.cut_of(np.zeros(0), np.zeros(0), 0.1, 0.9) == 0


def test_crc():
    assert tokens.crc(b"abc") == zlib.crc32(b"abc")


def test_new_units_are_encoded_a_few_at_a_time():
    import pyarrow as pa

    from kinweave.llm import tokens

    enc, most = tokens.Encoder(tokens.default_tokenizer()), []
    texts = [" ".join(f"w{i}x{j}" for j in range(5000)) for i in range(10)] + [None, "é ☃ a"]
    want = enc.encode(texts, 2)

    class Counting:
        def __init__(self, model):
            self.model = model

        def encode_batch_fast(self, given, **kw):
            most.append(len(given))
            return self.model.encode_batch_fast(given, **kw)

    fresh = tokens.Encoder(tokens.default_tokenizer())
    fresh.bare = Counting(fresh.bare)
    ids, sizes = fresh.flat(pa.array(texts), 2)
    assert ids.astype("<u4").tobytes() == b"".join(want) and sizes.tolist() == [len(x) // 4 for x in want]
    assert max(most) <= 8
    assert list(tokens.slices(pa.array(["ab", None, "cde", "f"]), 3)) == list(tokens.slices(["ab", None, "cde", "f"], 3)) == [(0, 2), (2, 3), (3, 4)]


def test_operators_keep_as_many_words_as_they_say():
    path = tokens.default_tokenizer()
    texts = [" ".join(f"w{i}x{j}" for i in range(40)) for j in range(20)]
    plain = tokens.encoder(path).tokenizer.encode_batch(texts, add_special_tokens=False)
    e = tokens.encoder(path, 50)
    try:
        for _ in range(2):
            for t, p in zip(texts, plain):
                assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == p.ids
                assert len(e.known) <= 50 + 2 * 41  # a call's new words come on top
    finally:
        assert tokens.encoder(path) is e and e.kept == tokens.KEPT_WORDS
