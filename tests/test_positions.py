"""The state of a position, call by call: what waits is taken up at once, and open lots lie in pages."""

import random
from types import SimpleNamespace

import pytest

from tidemark.streaming import positions


class Store:
    """A state variable of any kind, in a dict; ``calls`` counts what is read and written."""

    def __init__(self):
        self.values, self.calls = {}, 0

    def _called(self, value=None):
        self.calls += 1
        return value

    def get(self):
        return self._called(list(self.values["list"]) if "list" in self.values else self.values.get("value"))

    def put(self, values):
        self._called(self.values.update({"list": list(values)}))

    def appendList(self, values):
        self._called(self.values.update({"list": [*self.values.get("list", []), *values]}))

    def clear(self):
        self._called(self.values.update({"list": []}))

    def update(self, value):
        self._called(self.values.update({"value": value}))

    def getValue(self, key):
        return self._called(self.values[key])

    def updateValue(self, key, value):
        self._called(self.values.update({key: tuple(map(list, value))}))

    def removeKey(self, key):
        self._called(self.values.pop(key))


def processor():
    made = positions.PositionProcessor()
    waiting, lots, totals, timers = Store(), Store(), Store(), []
    waiting.values["list"] = []
    handle = SimpleNamespace(getListState=lambda *_: waiting, getMapState=lambda *_: lots, getValueState=lambda *_: totals, registerTimer=timers.append)
    made.init(handle)
    return made, waiting, lots, totals, timers


FIELDS = [c.split()[0] for c in positions.OUTPUT.replace("datetime", "at").split(", ")]


def fire(made, timers, reached):
    found = []
    for at in sorted(t for t in timers if t <= reached):
        timers.remove(at)
        found += [SimpleNamespace(**dict(zip(FIELDS, r, strict=True))) for r in made.handleExpiredTimer((1, 2), SimpleNamespace(getCurrentWatermarkInMs=lambda: reached), None)]
    return found


def trade(at, block, shares, price=1.0):
    return SimpleNamespace(at=at, block_number=block, shares=shares, price=price)


def test_a_batch_costs_a_position_a_few_calls_whatever_its_trades():
    made, waiting, lots, totals, timers = processor()
    made.handleInputRows((1, 2), iter([trade(5000 * n, n, 1.0 if n % 2 else -1.0) for n in range(1, 501)]), None)
    assert len(timers) == 1 and waiting.calls == 1
    assert len(fire(made, timers, 10_000)) == 500
    assert waiting.calls + lots.calls + totals.calls <= 6 and not timers


def test_what_the_watermark_has_not_passed_waits_on():
    made, waiting, _, _, timers = processor()
    made.handleInputRows((1, 2), iter([trade(9_000, 9, 1.0), trade(1_000, 1, 1.0), trade(1_000, 0, 2.0), trade(5_000, None, 1.0)]), None)
    made.handleInputRows((1, 2), iter([trade(4_000, 4, 1.0), trade(4_001, 5, 1.0)]), None)
    assert [(r.at, r.block_number, r.balance) for r in fire(made, timers, 4)] == [(1_000, 0, 2.0), (1_000, 1, 3.0), (4_000, 4, 4.0)]
    assert [r.at for r in fire(made, timers, 5)] == [4_001] and sorted(c[0] for c in waiting.values["list"]) == [9_000]
    assert [r.balance for r in fire(made, timers, 9)] == [6.0] and not timers


def test_a_trade_without_time_comes_first_and_one_without_shares_shows_no_balance():
    made, _, _, _, timers = processor()
    made.handleInputRows((1, 2), iter([trade(1_000, 1, None), trade(None, 3, 2.0)]), None)
    found = fire(made, timers, 1)
    assert [(r.at, r.block_number, r.balance, r.remaining_shares) for r in found] == [(None, 3, 2.0, 2.0), (1_000, 1, None, 2.0)]


@pytest.mark.parametrize("seed", range(4))
def test_pages_of_lots_against_a_plain_queue(seed, monkeypatch):
    monkeypatch.setattr(positions, "PAGE", 4)
    rng, queue, realized = random.Random(seed), [], 0.0
    made, _, lots, _, timers = processor()
    for batch in range(12):
        trades = [trade(1000 * (100 * batch + n), n, float(rng.choice([1, 2, 3, 5, -1, -2, -6, -9])), float(rng.randint(1, 9))) for n in range(rng.randint(1, 40))]
        made.handleInputRows((1, 2), iter(rng.sample(trades, len(trades))), None)
        found = fire(made, timers, 100 * batch + 99)
        for t, r in zip(trades, found, strict=True):
            if t.shares > 0:
                queue.append([t.shares, t.price])
            left = -t.shares
            while left > 0 and queue:
                sold = min(left, queue[0][0])
                realized, left = realized + sold * (t.price - queue[0][1]), left - sold
                queue[0][0] -= sold
                if not queue[0][0]:
                    queue.pop(0)
            assert (r.realized_pnl, r.remaining_shares, r.remaining_cost) == (realized, sum(q[0] for q in queue), sum(q[0] * q[1] for q in queue))
        assert len(lots.values) <= len(queue) // 4 + 2
