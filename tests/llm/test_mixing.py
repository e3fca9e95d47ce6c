import pytest

from conftest import SMALL
from tidemark.llm import mixing
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("weights,period", [({"a": 1, "b": 1}, 10), ({"a": .9, "b": .07, "c": .03}, 100),
                                            ({f"s{i}": i + 1 for i in range(37)}, 997), ({"x": 5}, 3)])
def test_period_deviation_is_below_one_block(weights, period):
    quota = mixing.quotas(weights, period)
    assert sum(quota.values()) == period
    slots = mixing.period_slots(quota)
    assert sorted(t for _, _, t in slots) == list(range(period))
    done = dict.fromkeys(quota, 0)
    for s, i, t in sorted(slots, key=lambda x: x[2]):
        assert i == done[s]
        assert i * period // quota[s] <= t < -(-(i + 1) * period // quota[s])       # released, not late
        done[s] += 1
        for x, q in quota.items():
            assert abs(done[x] - q * (t + 1) / period) < 1


def brute(rows, weights, block, period):
    """Slot of each (source, block), walking slot by slot."""
    sizes = {}
    for _, s in rows:
        sizes[s or ""] = sizes.get(s or "", 0) + 1
    quota = mixing.quotas({s: float(weights[s]) for s in sizes}, period)
    plan = {t: (s, i) for s, i, t in mixing.period_slots(quota)}
    left = {s: -(-n // block) for s, n in sizes.items()}
    next_block, out, t = dict.fromkeys(sizes, 0), {}, 0
    while any(next_block[s] < left[s] for s in sizes):
        s, _ = plan[t % period]
        if next_block[s] < left[s]:
            out[s, next_block[s]] = t
            next_block[s] += 1
        t += 1
    return sizes, out


def test_mix_matches_slot_by_slot(spark):
    rows = [(i, ["web", "web", "web", "code", "books", None][i * i % 6]) for i in range(700)]
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, source string, mix_slot int, src string")
    weights = {"web": .5, "code": .2, "books": .2, "": .1}
    got = mixing.mix(df, weights, block=8, period=50).collect()
    sizes, want = brute(rows, weights, 8, 50)
    assert sorted(r.doc_id for r in got) == list(range(700)) and {r.src for r in got} == {"h"}
    by = {}
    for r in got:
        assert want[r.source or "", r.mix_block] == r.mix_slot
        by.setdefault((r.source or "", r.mix_block), []).append(r.mix_order - 8 * r.mix_slot)
    for (s, b), places in by.items():
        assert sorted(places) == list(range(min(8, sizes[s] - 8 * b)))


def test_query(spark):
    got = QUERIES["op7_mixing"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == list(range(200))
    assert len({r.mix_order for r in got}) == 200


def test_odd_rows(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, "a", "t"), (1, "a", "t"), (None, None, None), (2, "a", "")], schema)
    got = mixing.mix(df, {"a": 2, "": 1}).collect()
    assert len(got) == 4 and len({r.mix_order for r in got}) == 4
    with pytest.raises(ValueError):
        mixing.mix(df, {"a": 1})
    with pytest.raises(ValueError):
        mixing.quotas({"a": 0}, 5)
    with pytest.raises(ValueError):
        mixing.quotas({"a": 1, "b": 1}, 1)


def unequal(n):
    """20 sources, one with a third of n rows."""
    return [(i, "big" if i % 3 == 0 else f"s{i % 19}") for i in range(n)]


def test_mix_keeps_to_target_weights(spark):
    rows = unequal(4000)
    sizes = {}
    for _, s in rows:
        sizes[s] = sizes.get(s, 0) + 1
    total = sum(n ** .5 for n in sizes.values())
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), block=1).collect()
    assert sorted(r.doc_id for r in got) == list(range(4000)) and len({r.mix_slot for r in got}) == 4000
    for r in got:                                       # released, not late, by the exact target weight
        w = sizes[r.source] ** .5 / total
        assert r.mix_block / w - 1 - 1e-6 < r.mix_slot < (r.mix_block + 1) / w + 1e-6, r
    at = {r.mix_slot: r.source for r in got}
    done, target = dict.fromkeys(sizes, 0), {s: n ** .5 / total for s, n in sizes.items()}
    for t in range(max(at) + 1):
        if t in at:
            done[at[t]] += 1
        for s, w in target.items():
            assert done[s] == sizes[s] or abs(done[s] - w * (t + 1)) < 1 + 1e-6


def test_schedule_of_many_blocks_and_thin_sources():
    weights = {"a": 1e-7, "b": 1 / 3, "c": .1, "d": .5666}
    blocks = {"a": 40, "b": 20000, "c": 9000, "d": 1}
    names, src, blk, slot = mixing.block_slots(weights, blocks)
    total = sum(weights.values())
    assert len(slot) == sum(blocks.values()) == len(set(slot)) and list(slot) == sorted(slot)
    for k, i, t in zip(src, blk, slot):
        w = weights[names[k]] / total
        assert i / w - 1 - 1e-3 < t < (i + 1) / w + 1e-3
    assert mixing.block_slots({}, {}) == ([], *[mixing.array("q")] * 3)
    with pytest.raises(ValueError):
        mixing.block_slots({"a": 1, "b": -1}, {"a": 1, "b": 1})


def test_quotas_are_not_pulled_towards_equal_shares():
    weights = {"big": 980, **{f"s{i}": 1 for i in range(20)}}
    assert mixing.quotas(weights, 1000)["big"] == 980
