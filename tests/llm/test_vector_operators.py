"""Hard negatives and vector codes against brute force and SQL."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import codes, negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score long, place int, block int, slot int, code string, n int"


@pytest.fixture(scope="session")
def embeddings(spark):
    """Rows (vec_id, embedding, label) with columns whose names the operators use inside."""
    def build(rows):
        return spark.createDataFrame([(*r, 1, 2, 3, 4, "x", 5) for r in rows], SCHEMA)

    return build


def vectors_of(n, width, seed, spread=1.0):
    """Clustered vectors with ties: some repeat others, some are zero."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(6)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append([0.0] * width if i % 29 == 0 else list(out[i // 2]) if i % 11 == 5 else [x + rng.gauss(0, 0.1) * spread for x in c])
    return [np.array(v, dtype=np.float32).astype(float).tolist() for v in out]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_negatives(rows):
    rows = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows if i is not None and l is not None and usable(v)}
    out = []
    for i, label, v in rows:
        if i % 50:
            continue
        scored = sorted({(-sum(a * b for a, b in zip(v, w)), j, m == label) for j, m, w in rows})
        for p, j, same in [s for s in scored if s[2] and s[1] != i][:5]:
            hard = [s for s in scored if not s[2] and -50 * p <= -100 * s[0] <= -95 * p][:3]
            out += [(i, j, k + 1, s[1], -p, -s[0]) for k, s in enumerate(hard)]
    return sorted(out)


def mined(frame, **options):
    rows = negatives.prepared(frame)
    return sorted(tuple(r) for r in negatives.mine(rows, rows.where("vec_id % 50 = 0"), **options).collect())


def test_strassen_is_exact():
    rng = np.random.default_rng(1)
    for n, k, m in [(1, 1, 1), (3, 5, 7), (65, 64, 130), (33, 1, 40), (70, 90, 33), (4, 0, 4), (0, 4, 4)]:
        for largest in (300, 1 << 28):
            a, b = rng.integers(-largest, largest, (n, k)), rng.integers(-largest, largest, (k, m))
            for leaf in (1, 4, 32):
                assert (negatives.strassen(a, b, leaf) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = random.Random(3)
    rows = [(rng.randint(-5, 5), rng.randint(0, 40)) for _ in range(300)]
    for _ in range(5):
        rng.shuffle(rows)
        heaps = negatives.Heaps(2, 4)
        for at in range(0, 300, 37):
            part = rows[at:at + 37]
            scores, ids = np.array([[s for s, _ in part]] * 2), np.array([i for _, i in part])
            heaps.offer(slice(0, 2), scores, ids, np.array([[True] * len(part), [i % 2 == 0 for _, i in part]]))
        for line, chosen in enumerate((rows, [r for r in rows if r[1] % 2 == 0])):
            want = sorted(set(chosen), key=lambda r: (-r[0], r[1]))[:4]
            assert list(zip(heaps.scores[line].tolist(), heaps.ids[line].tolist())) == want


@pytest.mark.parametrize("block_rows", [4, 1000])
def test_negatives_equal_brute_force(embeddings, block_rows):
    rows = [(i, v, i * 7 % 5) for i, v in enumerate(vectors_of(700, 9, 5))]
    assert mined(embeddings(rows).repartition(5), block_rows=block_rows) == brute_negatives(rows)


def test_negatives_edges(embeddings):
    base = vectors_of(160, 6, 8)
    rows = [(i, v, i % 3) for i, v in enumerate(base)]
    rows += [(200, None, 1), (250, base[3], None), (None, base[4], 1), (300, [1.0, None, 0.0], 1),
             (350, [float("nan")] * 6, 0), (400, [float("inf")] + [0.0] * 5, 0), (450, [], 1), (500, base[7][:3], 2),
             (51, [1e30] * 6, 0)]
    rows += [rows[50], rows[50], rows[17]]  # repeated rows: an anchor and a candidate
    wanted = [r for r in rows if not (r[1] and r[1][0] == 1e30)]
    assert mined(embeddings(rows).repartition(3)) == brute_negatives(wanted)
    assert mined(embeddings([])) == []
    assert mined(embeddings([(50, [1.0, 0.0], 1)])) == []  # no positives
    assert mined(embeddings([(50, [1.0, 0.0], 1), (51, [1.0, 0.0], 1)])) == []  # no negatives


def test_one_vector_in_a_third_of_all_rows(embeddings):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors_of(300, 5, 9))]
    rows = [(i, rows[1][1], 1) if i % 3 == 0 else r for i, r in enumerate(rows)]
    assert mined(embeddings(rows).repartition(4)) == brute_negatives(rows)


def brute_codes(rows, entries=256):
    kept = [(i, tuple(math.floor(1024 * x) for x in v), l) for i, v, l in rows if usable(v)]
    width = len(min((r for r in kept if r[0] is not None))[1])
    kept = [r for r in kept if len(r[1]) == width]
    w = -(-width // 4)
    cut = {r[1]: [(list(r[1]) + [0] * (4 * w - width))[p * w:(p + 1) * w] for p in range(4)] for r in kept}
    first = sorted(r[:2] for r in kept if r[0] is not None)[:entries]
    books = [[list(cut[v][p]) for _, v in first] for p in range(4)]

    def nearest(p, piece):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e)), k) for k, e in enumerate(books[p]))

    for _ in range(4):
        for p in range(4):
            taken = {}
            for r in kept:
                taken.setdefault(nearest(p, cut[r[1]][p])[1], []).append(cut[r[1]][p])
            for k, pieces in taken.items():
                books[p][k] = [sum(c) // len(pieces) for c in zip(*pieces)]
    out = []
    for i, v, label in kept:
        found = [nearest(p, cut[v][p]) for p in range(4)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(out, key=str), digest


@pytest.mark.parametrize("n,width,options", [
    (90, 8, {}), (700, 8, {"entries": 40, "chunk": 64, "block": 8}), (300, 10, {"entries": 16, "chunk": 1000, "block": 500}),
    (40, 3, {}), (300, 4, {"entries": 5, "block": 1})])
def test_codes_equal_brute_force(embeddings, n, width, options):
    rows = [(i, v, i % 4 or None) for i, v in enumerate(vectors_of(n, width, n))]
    found, books = codes.compress(embeddings(rows).repartition(3), **options)
    want, digest = brute_codes(rows, options.get("entries", 256))
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert codes.digest(books) == digest


def test_codes_edges(embeddings):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors_of(60, 8, 2))]
    extra = [(100, None, 1), (101, [1.0] * 7 + [None], 1), (102, [float("nan")] * 8, 1), (103, [1.0] * 5, 1),
             (104, [float("-inf")] * 8, 1), (105, [1e30] * 8, 1), (None, rows[3][1], 2), rows[5], rows[5]]
    found, books = codes.compress(embeddings(rows + extra), entries=20)
    want, digest = brute_codes([r for r in rows + extra if not (r[1] and r[1][0] == 1e30)], 20)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want and codes.digest(books) == digest
    empty, books = codes.compress(embeddings([]))
    assert empty.collect() == [] and books.shape == (4, 1, 0)
    nameless, _ = codes.compress(embeddings([(None, [1.0, 2.0], 1)]))
    assert [tuple(r) for r in nameless.collect()] == [(None, 1, "00000000", 0)]  # the rounds move the one entry there
    flat, _ = codes.compress(embeddings([(1, [], None)]))
    assert [tuple(r) for r in flat.collect()] == [(1, None, "00000000", 0)]
    with pytest.raises(ValueError):
        codes.compress(embeddings([]), entries=257)


def test_shortlists_never_lose_the_nearest_entry_and_prune():
    points = np.array([[math.floor(1024 * x) for x in v] for v in vectors_of(2000, 16, 4)], dtype=np.int64)
    chunk, book = codes.Chunk.of(points, 4, 32), points[:64].reshape(64, 4, 4)
    listed = [chunk.shortlists(p, np.ascontiguousarray(book[:, p])) for p in range(4)]
    assert np.mean(listed) < 0.6
    for p in range(4):
        again = codes.Chunk.read(chunk.buffers(), 2000, 4, 32)
        code, error, counts, sums = again.assign(p, np.ascontiguousarray(book[:, p]), 32, errors=True)
        distance = ((chunk.pieces[p][:, None, :] - book[None, :, p]) ** 2).sum(axis=2)
        assert (code == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
        assert (counts == np.bincount(code, minlength=64)).all() and (sums.sum(axis=0) == chunk.pieces[p].sum(axis=0)).all()


def test_hilbert_order_steps_to_neighbours():
    grid = np.stack(np.meshgrid(np.arange(16), np.arange(16), indexing="ij"), axis=-1).reshape(-1, 2)
    walk = grid[codes.hilbert_order(grid * 4369)]  # 65535 / 15: the grid of 16 bits a side, every 4369th point
    steps = np.abs(np.diff(walk, axis=0)).sum(axis=1)
    assert sorted(map(tuple, walk.tolist())) == sorted(map(tuple, grid.tolist()))
    assert (steps == 1).mean() > 0.95


def test_large_products_stay_exact():
    a = np.full((2, 3), 1 << 27, dtype=np.int64)
    assert (vectors.product(a, a.T + 1) == a.astype(object) @ (a.T + 1).astype(object)).all()
