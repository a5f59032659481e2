import math
import zlib
from collections import Counter

import numpy as np
import pytest
from awkward_rows import AWKWARD, awkward, nothing  # noqa: F401
from conftest import SF001

from propensia.llm import pitman_yor as hpy


def words_of(text):
    return (text or "").encode().lower().split() + [b""]


def held(key, modulus=7, fold=2):
    return zlib.crc32(("" if key is None else str(key)).encode()) % modulus == fold


def compare_base(rows, docs):
    counts = Counter(w for k, t in docs if not held(k) for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for k, t in docs:
        w = words_of(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want.append((k is None, k or 0, held(k), len(w), sum(counts[x] > 0 for x in w), n, round(base, 4)))
    got = [(r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows]
    assert sorted(got) == sorted(want)


def test_awkward_rows_and_empty_table(spark, awkward, nothing):  # noqa: F811
    rows = hpy.score_documents(awkward).collect()
    compare_base(rows, AWKWARD)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert hpy.score_documents(nothing).count() == 0


def test_no_training_text(spark):
    key = next(k for k in range(100) if held(k))
    docs = spark.createDataFrame([(key, "some words")], "doc_id long, text string")
    (r,) = hpy.score_documents(docs).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0)
    assert r["score"] == pytest.approx(0.0)


@pytest.fixture(scope="module")
def scored(spark):
    return hpy.query(spark, SF001).collect()


def test_base_on_the_given_table(spark, scored):
    compare_base(scored, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()])


def test_held_out_perplexity_beats_the_base(scored):
    rows = [r for r in scored if r["held_out"]]
    n = sum(r["n_tokens"] for r in rows)
    base, model = (10 ** (-sum(r[c] for r in rows) / n) for c in ("base_score", "score"))
    assert model < 0.8 * base


def test_runs_repeat_and_batches_only_regroup(spark, awkward, monkeypatch):  # noqa: F811
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"])
    first, again = (sorted(hpy.score_documents(awkward).collect(), key=key) for _ in range(2))
    assert first == again
    other = sorted(hpy.score_documents(awkward.repartition(5)).collect(), key=key)
    assert [r["score"] for r in other] == pytest.approx([r["score"] for r in first], rel=1e-5)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    words = np.sort(rng.choice(2**62, 300, replace=False).astype(np.uint64))
    per = rng.integers(1, 6, 300)
    context = np.concatenate([np.sort(rng.choice(hpy.CONTEXTS, n, replace=False)) for n in per]).astype(np.uint8)
    counts = rng.geometric(0.2, per.sum())
    part = hpy.pack(words, hpy.smallest(per), context, hpy.smallest(counts))
    state, sampled = hpy.Restaurants.merge([part, part]), []
    assert state.c.sum() == 2 * counts.sum()
    for _ in range(4):
        state.sweep(hpy.Totals(state.totals()), rng)
        assert (state.t >= 1).all() and (state.t <= state.c).all()
        assert (state.t0 >= 1).all() and (state.t0 <= state.customers0()).all()
        state.samples.append((state.t.copy(), state.t0.copy()))
        sampled.append(hpy.Totals(state.totals()))
    state = hpy.Restaurants.load(state.dump())
    unknown = np.uint64(2**63)
    everything = np.append(words, unknown)
    for k in (0, 7, int(context[0])):
        ask = hpy.pack(everything, np.ones(301, np.uint8), np.full(301, k, np.uint8), np.zeros(301, np.uint8))
        known, logs = hpy.unpack(state.answer(ask, sampled))
        assert (10.0 ** logs.astype(float)).sum() == pytest.approx(1.0, abs=1e-4)
        assert known[-1] == 0 and (known[:-1] > 0).all()


def brute_alone(c, t, d):
    """Share of seatings of c customers at t tables in which the last sits alone, by enumeration."""
    weights = {}

    def seat(tables, weight):
        if sum(tables) == c:
            alone = tables[-1] == 1 and seat.last_new
            weights.setdefault(len(tables), [0.0, 0.0])[int(alone)] += weight
            return
        for i in range(len(tables)):
            seat.last_new = False
            seat(tables[:i] + [tables[i] + 1] + tables[i + 1 :], weight * (tables[i] - d))
        seat.last_new = True
        seat([*tables, 1], weight)

    seat.last_new = True
    seat([1], 1.0)
    joined, alone = weights[t]
    return alone / (joined + alone)


@pytest.mark.parametrize("d", [0.2, 0.7])
def test_chance_of_sitting_alone_equals_enumeration(d):
    logs = hpy.stirling(d)
    for c in range(2, 7):
        for t in range(1, c + 1):
            assert math.exp(logs[c - 1, t - 1] - logs[c, t]) == pytest.approx(brute_alone(c, t, d), abs=1e-9), (c, t)


def test_draws_agree_with_the_exact_posterior():
    """Dishes of 5 customers: drawn tables follow their exact distribution."""
    d, new = 0.5, 0.8  # new: (a + d T) P0, held fixed as a sweep does
    exact = np.exp(exact_logs(5, d)) * new ** np.arange(1, 6)
    c = np.full(60_000, 5)
    t = hpy.draw(c, np.full(len(c), d), hpy.stirling(d)[None], np.zeros(len(c), np.int64), lambda n, t: t * math.log(new), np.random.default_rng(3))
    assert np.bincount(t, minlength=6)[1:] / len(t) == pytest.approx(exact / exact.sum(), abs=0.01)


def test_arrays_round_trip():
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.uint8), np.array([1.5, 2.5], np.float32)]
    for a, b in zip(arrays, hpy.unpack(hpy.pack(*arrays))):
        assert a.dtype == b.dtype and (a == b).all()


def exact_logs(c, d):
    """log S_d(c, t), t = 1..c, by the recursion."""
    t, logs = np.arange(1, c + 1), np.full(c + 1, -np.inf)
    logs[0] = 0.0
    for n in range(1, c + 1):
        with np.errstate(divide="ignore"):
            logs[1:], logs[0] = np.logaddexp(logs[:-1], np.log(np.maximum(n - 1 - d * t, 0)) + logs[1:]), -np.inf
    return logs[1:]


@pytest.mark.parametrize("d", [0.05, 0.4, 0.8, 0.95])
def test_stirling_numbers_of_many_customers(d):
    exact = exact_logs(1200, d)
    assert hpy.log_stirling(1200, np.arange(1, 1201), d) == pytest.approx(exact, abs=0.005)


def exact_column(top, t0, d):
    """log S_d(c, t0), c = 0..top, by the recursion."""
    t, logs, out = np.arange(1, t0 + 1), np.full(t0 + 1, -np.inf), np.full(top + 1, -np.inf)
    logs[0] = 0.0
    for n in range(1, top + 1):
        with np.errstate(divide="ignore"):
            logs[1:], logs[0] = np.logaddexp(logs[:-1], np.log(np.maximum(n - 1 - d * t, 0)) + logs[1:]), -np.inf
        out[n] = logs[t0]
    return out


@pytest.mark.parametrize("d", [0.1, 0.5, 0.8])
@pytest.mark.parametrize(("rest", "c", "t0"), [(200, 250, 50), (300, 255, 200), (300, 200, 290), (2000, 255, 1000), (3000, 90, 4), (100, 900, 60)])
def test_parent_seatings_beyond_the_table(d, rest, c, t0):
    t = np.arange(1, c + 1)
    found = hpy.ParentSeatings(np.array([9, rest]), np.array([3, c]), np.array([2, t0]), d, hpy.stirling(d))(np.ones(c, np.int64), t)
    want = exact_column(rest + c, t0, d)[rest + t]
    assert (np.isfinite(found) == np.isfinite(want)).all()
    ok = np.isfinite(want)
    assert found[ok] == pytest.approx(want[ok], abs=0.006)
    assert np.diff(found[ok]) == pytest.approx(np.diff(want[ok]), abs=0.006)


@pytest.mark.parametrize(("c", "total", "rest", "t0"), [
    (40, 300, 0, 1), (40, 300, 90, 1), (900, 4000, 0, 1), (900, 4000, 2500, 1), (6000, 900, 40, 1),
    (40, 300, 900, 50), (200, 900, 1500, 1000), (900, 4000, 2500, 300), (250, 900, 150, 100),
])
def test_a_sweep_seats_all_customers_by_the_exact_posterior(c, total, rest, t0):
    """From merge()'s guess one sweep gives many like dishes the table counts of the exact posterior."""
    n = 1500
    words = np.sort(np.random.default_rng(1).choice(2**62, n, replace=False).astype(np.uint64))
    state = hpy.Restaurants.merge([hpy.pack(words, np.ones(n, np.uint8), np.full(n, 5, np.uint8), np.full(n, c))])
    guess = int(state.t[0])
    if rest:  # the word's tables in another restaurant, of one customer each
        state = hpy.Restaurants(words, np.full(n, 2), np.tile([5, 6], n), np.tile([c, rest], n), np.tile([guess, rest], n), np.ones(n), [])
    sums = np.zeros(4 * (hpy.CONTEXTS + 1) + 1)
    m = sums[:-1].reshape(4, -1)
    m[0], m[1], m[2], m[3], sums[-1] = 10 * total, total, 4, 2, 1000
    m[0, -1], m[1, -1] = 50 * total, 1200
    totals = hpy.Totals(sums)
    assert set(totals.discount) == {0.5}
    state.t0[:] = t0
    t = np.arange(1, c + 1)
    logs = exact_logs(c, 0.5) + t * math.log(0.5)
    logs += [math.lgamma(2 + total - guess + x) for x in t]
    logs += exact_column(rest + c, t0, 0.5)[rest + t] - [math.lgamma(1 + 50 * total - guess + x) for x in t]
    p = np.exp(logs - logs.max())
    p /= p.sum()
    mean, spread = p @ t, math.sqrt(p @ t**2 - (p @ t) ** 2)
    state.sweep(totals, np.random.default_rng(7))
    got = state.t[state.context == 5]
    assert abs(got.mean() - mean) < 5 * spread / math.sqrt(n)
    assert got.std() == pytest.approx(spread, rel=0.12)
    assert np.abs(np.cumsum(np.bincount(got, minlength=c + 1)[1:]) / n - np.cumsum(p)).max() < 0.06


def test_millions_of_customers_leave_the_first_guess():
    """Tables of a very frequent dish follow the share its word has at the parent, not its count's power."""
    n = 50
    words = np.sort(np.random.default_rng(1).choice(2**62, n, replace=False).astype(np.uint64))
    counts = np.full(n, 10**6)
    state = hpy.Restaurants.merge([hpy.pack(words, np.ones(n, np.uint8), np.full(n, 5, np.uint8), counts)])
    assert set(state.t) == {3981}
    state.sweep(hpy.Totals(state.totals()), np.random.default_rng(7))
    assert len(set(state.t)) > 40 and np.abs(state.t - 3981).max() > 100


def test_every_ending_has_a_restaurant_of_its_own(spark):
    """No two endings share one, and words after unlike endings learn apart."""
    endings = [b"", *(bytes([a]) for a in range(256)), *(bytes([a, b]) for a in range(256) for b in range(256))]
    assert len({hpy.context_of(e) for e in endings}) == len(endings) == hpy.CONTEXTS
    assert hpy.context_of(b"abcd") == hpy.context_of(b"cd")
    letters = "abcdefghijklmnopqrst"
    pairs = [(f"x{a}{b}", f"then_{a}{b}") for a in letters for b in letters]  # 400 endings
    train = [k for k in range(400) if not held(k)][:24]
    test = [k for k in range(400) if held(k)][:2]
    order = np.random.default_rng(2).permutation(len(pairs))
    text = " ".join(w for i in order for w in pairs[i])
    wrong = " ".join(w for i, j in zip(order, np.roll(order, 1)) for w in (pairs[i][0], pairs[j][1]))
    docs = [(k, text) for k in train] + [(test[0], text), (test[1], wrong)]
    rows = {r["doc_id"]: r["score"] for r in hpy.score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    # a word after its own ending is nearly sure; where eight endings share a restaurant it is one of eight
    assert rows[test[0]] > -400
    assert rows[test[0]] - rows[test[1]] > 2.5 * 400


def test_many_contexts_of_a_word_keep_its_sums():
    """Contexts that are drawn at once: the parent's customers stay the sum of their tables."""
    rng = np.random.default_rng(3)
    words = np.sort(rng.choice(2**62, 4, replace=False).astype(np.uint64))
    context = np.concatenate([np.sort(rng.choice(hpy.CONTEXTS, 300, replace=False)) for _ in words])
    part = hpy.pack(words, np.full(4, 300, np.uint16), context.astype(np.uint32), rng.geometric(0.01, 1200))
    state = hpy.Restaurants.merge([part])
    for _ in range(3):
        state.sweep(hpy.Totals(state.totals()), rng)
        assert (state.t >= 1).all() and (state.t <= state.c).all()
        assert (state.t0 >= 1).all() and (state.t0 <= state.customers0()).all()
    at, values = state.sums()
    dense = np.zeros(4 * (hpy.CONTEXTS + 1) + 1)
    dense[at] = values
    assert (dense == state.totals()).all()


def test_every_word_has_a_restaurant_of_its_own(spark):
    """Words of one ending, which share the restaurant above, are followed by words of their own."""
    n = 200
    pairs = [(f"{chr(97 + i // 26)}{chr(97 + i % 26)}_same", f"then{i}") for i in range(n)]
    train = [k for k in range(400) if not held(k)][:24]
    test = [k for k in range(400) if held(k)][:2]
    order = np.random.default_rng(2).permutation(n)
    text = " ".join(w for i in order for w in pairs[i])
    wrong = " ".join(w for i, j in zip(order, np.roll(order, 1)) for w in (pairs[i][0], pairs[j][1]))
    docs = [(k, text) for k in train] + [(test[0], text), (test[1], wrong)]
    rows = {r["doc_id"]: r["score"] for r in hpy.score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    # with restaurants of endings alone both texts score alike, about log10(1 / 200) a pair
    assert rows[test[0]] > -n
    assert rows[test[0]] - rows[test[1]] > 2 * n


def followers(texts, buckets=1):
    batch = hpy.Batch()
    for i, text in enumerate(texts):
        batch.add(i, text, False)
    parts = [data for b, data in batch.rows(buckets) if b >= 0]
    return hpy.Pairs(parts), hpy.Followers.merge(hpy.Pairs(parts), buckets)


def totals_of(state):
    sums = np.zeros(hpy.SIZE + 3)
    at, values = state.sums()
    sums[at] = values
    return hpy.Totals(sums[: hpy.SIZE]), sums[hpy.SIZE :]


def test_probabilities_after_a_word_sum_to_one():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}{'xy'[i % 2]}" for i in np.minimum(rng.geometric(0.15, 60), 30)) for _ in range(40)]
    pairs, state = followers(texts)
    counts = Counter(p for t in texts for p in zip([b"", *words_of(t)], words_of(t)))
    visits = Counter(p for t in texts for p in words_of(t))
    assert sum(counts.values()) == totals_of(state)[1][0] and sum(v == 1 for v in counts.values()) == totals_of(state)[1][1]
    hashes = {hpy.xxhash.xxh3_64_intdigest(w): w for w in visits}
    d, saved, sampled = 0.6, {}, []
    visited = np.array([visits[hashes[int(h)]] for h in state.names])
    for n in range(4):
        own = [hpy.unpress(x) for x in state.sent(1) if x]
        state.hear([hpy.press(hpy.pack(own[0][1], visited))])
        state = hpy.Followers.load(state.dump())
        state.hear([hpy.press(hpy.pack(own[0][1], visited))])
        state.sweep(totals_of(state)[0], d, rng)
        assert (state.t >= 1).all() and (state.t <= state.c).all()
        assert (state.above.c == state.customers(state.t)).all()
        assert (state.above.t >= 1).all() and (state.above.t <= state.above.c).all()
        state.sample()
        names, values = hpy.unpress(state.sent(1)[0])
        saved[n] = hpy.press(hpy.pack(hpy.from_planes(names), values))
        sampled.append(totals_of(state)[0])
    # a part that asks for every word after some words, known, of one occurrence and unknown
    words = [*visits, b"unknown"]
    before = [b"", b"w1y", b"w2x", b"w30x", b"never"]
    ask = sorted((hpy.xxhash.xxh3_64_intdigest(w) for w in words))
    names = np.array([hpy.xxhash.xxh3_64_intdigest(w) for w in before], np.uint64)
    k, v = len(before), len(words)
    own_ends = np.array([hpy.context_of(w) for w in before])
    part = hpy.press(hpy.pack(hpy.planes(np.array(ask, np.uint64)), np.full(v, k), np.tile(np.arange(k), v), np.zeros(k * v, np.int64), hpy.planes(names), own_ends))
    batch = hpy.Batch()
    for i, text in enumerate(texts):
        batch.add(i, text, False)
    everything = hpy.Pairs([*(data for b, data in batch.rows(1) if b >= 0), part])
    *_, data = state.answers(everything, saved)
    count, c, *arrays = (a.astype(float) for a in hpy.unpress(data))
    known = dict(zip(ask, count))
    assert all(known[h] == visits[w] for h, w in hashes.items())
    got = c.reshape(v, k)
    assert all(got[i, j] == counts[(before[j], hashes.get(h))] for i, h in enumerate(ask) for j in range(k))
    ends, dish = np.unique(np.repeat(np.arange(v), k) * hpy.CONTEXTS + np.tile(own_ends, v), return_inverse=True)
    for n in range(4):
        fewer, c0, t0, fewer_here, c1, t1 = arrays[6 * n : 6 * n + 6]
        p_ending = sampled[n].chance(c0, t0, c1, t1, ends // hpy.CONTEXTS, ends % hpy.CONTEXTS)[dish]
        at = dict(zip(ask, fewer))
        customers = np.tile([visits[w] for w in before], v)
        rest = np.tile([at.get(int(h), 0) for h in names], v)
        p = hpy.served(c, fewer_here, customers, rest, p_ending, d).reshape(v, k)
        assert p.sum(axis=0) == pytest.approx(1.0, abs=1e-5)
        assert p[:, -1] == pytest.approx(p_ending.reshape(v, k)[:, -1])  # a word never seen leaves it to its ending


@pytest.mark.parametrize(("c", "tables", "ones", "t2"), [(6, 40, 3, 2), (40, 300, 0, 1), (40, 300, 500, 30), (900, 3000, 20, 5)])
def test_a_sweep_seats_followers_by_the_exact_posterior(c, tables, ones, t2):
    """Many like dishes after one word, each under a dish of its own: their table counts follow the exact posterior."""
    n, guess = 1500, max(1, round(c**0.6))
    words = np.sort(np.random.default_rng(1).choice(2**62, n, replace=False).astype(np.uint64))
    above = hpy.Restaurants(words, np.ones(n), np.full(n, 5), np.full(n, ones + guess), np.full(n, t2), np.ones(n), [])
    state = hpy.Followers(above, np.full(n, ones), words[:1], np.array([10**6]), np.arange(n), np.zeros(n), np.full(n, c), np.full(n, guess), [])
    state.saved[:] = 10**6 - tables
    sums = np.zeros(hpy.SIZE)
    m = sums[:-1].reshape(4, -1)
    m[0], m[1], m[2], m[3], sums[-1] = 10 * tables, tables, 4, 2, 1000
    d = 0.7
    t = np.arange(1, c + 1)
    logs = exact_logs(c, d) + t * math.log(d) + [math.lgamma(1 / d + tables - guess + x) for x in t]
    logs += exact_column(ones + c, t2, 0.5)[ones + t] - [math.lgamma(1 + 10 * tables - guess + x) for x in t]
    p = np.exp(logs - logs.max())
    p /= p.sum()
    mean, spread = p @ t, math.sqrt(p @ t**2 - (p @ t) ** 2)
    state.sweep(hpy.Totals(sums), d, np.random.default_rng(7))
    assert abs(state.t.mean() - mean) < 5 * spread / math.sqrt(n) + 1e-9
    assert np.abs(np.cumsum(np.bincount(state.t, minlength=c + 1)[1:]) / n - np.cumsum(p)).max() < 0.06
