import tracemalloc

import numpy as np

from metaspark.llm import recurrent


def windows(rnd, steps, lanes):
    inputs, targets = rnd.integers(0, recurrent.SYMBOLS, (2, steps, lanes))
    return inputs, targets, rnd.random((steps, lanes)) < 0.02, rnd.standard_normal((lanes, recurrent.HIDDEN)).astype(np.float32)


def test_training_step_keeps_its_work_arrays():
    network = recurrent.Network.fresh(np.ones(recurrent.SYMBOLS))
    some = windows(np.random.default_rng(1), recurrent.WINDOW, recurrent.LANES)
    first = network.gradient(*some)
    tracemalloc.start()
    again = network.gradient(*some)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4 * recurrent.WINDOW * recurrent.LANES * recurrent.HIDDEN * 4  # four of some twenty arrays of a window
    assert first[0] == again[0] and np.array_equal(first[1], again[1]) and np.array_equal(first[2], again[2])


def test_scoring_states_equal_training_states():
    rnd = np.random.default_rng(2)
    network = recurrent.Network.fresh(rnd.random(recurrent.SYMBOLS) + 0.1)
    inputs, _, fresh, state = windows(rnd, 40, 7)
    kept = network.states(inputs, fresh, state)[0].copy()
    assert np.array_equal(network.states(inputs, fresh, state, keep=False)[0], kept)
    state = np.where(fresh[0][:, None], 0, state)
    wide = {k: v.astype(np.float64) for k, v in network.p.items()}
    for t in range(len(inputs)):
        state = np.where(fresh[t][:, None], 0, state)
        z, r, new = np.split(wide["x"][inputs[t]], 3, axis=1)
        to_z, to_r = np.split(wide["u"], 2, axis=1)
        z, r = 1 / (1 + np.exp(-z - state @ to_z)), 1 / (1 + np.exp(-r - state @ to_r))
        state = state + z * (np.tanh(new + (r * state) @ wide["ug"]) - state)
        assert np.allclose(kept[t], state, atol=1e-5)


def test_log_probabilities_in_blocks_equal_a_plain_softmax():
    rnd = np.random.default_rng(3)
    network = recurrent.Network.fresh(rnd.random(recurrent.SYMBOLS) + 0.1)
    network.flat += rnd.standard_normal(len(network.flat)).astype(np.float32) * 0.3
    size = 3 * recurrent.BLOCK + 5
    states = rnd.standard_normal((size, recurrent.HIDDEN)).astype(np.float32)
    targets = np.where(rnd.random(size) < 0.8, recurrent.END, rnd.integers(0, recurrent.SYMBOLS, size))
    plain = lambda v: v - np.log(np.exp(v).sum(axis=1, keepdims=True))
    p = {k: v.astype(np.float64) for k, v in network.p.items()}
    group, member, at = targets // recurrent.GROUP, targets % recurrent.GROUP, np.arange(size)
    inner = np.einsum("nh,nhm->nm", states, p["w"][group]) + p["bw"][group]
    want = plain(states @ p["g"] + p["bg"])[at, group] + plain(inner)[at, member]
    assert np.allclose(network.log_probabilities(states, targets), want, atol=1e-4)
    assert np.allclose(network.log_probabilities(states, targets, {}), want, atol=1e-4)


def test_rows_are_summed_by_symbol():
    rnd = np.random.default_rng(4)
    network = recurrent.Network.fresh(np.ones(recurrent.SYMBOLS))
    for size in (1, 7, 5000):
        symbol = np.minimum(rnd.geometric(0.01, size), recurrent.SYMBOLS) - 1
        values = rnd.standard_normal((3, size, 4))
        want = np.zeros((recurrent.SYMBOLS, 12))
        np.add.at(want, symbol, np.concatenate(list(values), axis=1))
        assert np.allclose(network.by_symbol(values, symbol), want)


def test_lookup_equals_a_dictionary(spark):
    rnd = np.random.default_rng(5)
    shift = np.uint64(64 - recurrent.LOOKUP_BITS)
    near = (np.uint64(77) << shift) + np.arange(0, 60, 3, dtype=np.uint64)  # one place for all leading bits
    ends = np.array([0, 1, (1 << 64) - 2, (1 << 64) - 1], dtype=np.uint64)
    hashes = np.unique(np.concatenate([rnd.integers(0, 1 << 64, 3000, dtype=np.uint64), near, ends[1:3]]))
    rows = [(int(h), n + 1, n % recurrent.CLASSES) for n, h in enumerate(hashes.view(np.int64))]
    known = recurrent.summary(spark.createDataFrame(rows, "word long, n long, class int"), 9)
    assert np.array_equal(known.hashes, hashes)
    asked = np.concatenate([hashes, rnd.integers(0, 1 << 64, 3000, dtype=np.uint64), near + np.uint64(1), ends])
    place, symbol = recurrent.looked_up(known, asked)
    where = {h: k for k, h in enumerate(hashes.tolist())}
    assert place.tolist() == [where.get(h, -1) for h in asked.tolist()]
    assert symbol.tolist() == [int(known.symbols[k]) if k >= 0 else -1 for k in place.tolist()]
    assert (symbol >= 0).sum() >= recurrent.FIRST_CLASS
    none = recurrent.summary(spark.createDataFrame([], "word long, n long, class int"), 0)
    assert [v.tolist() for v in recurrent.looked_up(none, asked[:2])] == [[-1, -1], [-1, -1]]
