"""What the streaming fold asks of its state: every call is a message between Python and the JVM."""

import json

from tallyline.streaming import keyed

DAY = 86_400


class Calls:
    """A state that counts what is asked of it."""

    def __init__(self):
        self.value, self.legs, self.made, self.timers = None, {}, [], []

    def getValueState(self, name, schema):
        outer = self

        class Value:
            def get(self):
                outer.made.append("get")
                return outer.value

            def update(self, value):
                outer.made.append("update")
                outer.value = value

            def clear(self):
                outer.made.append("clear")
                outer.value = None
        return Value()

    def getMapState(self, name, key, value):
        outer = self

        class Legs:
            def getValue(self, k):
                outer.made.append("leg")
                return outer.legs.get(k)

            def updateValue(self, k, v):
                outer.made.append("leg update")
                outer.legs[k] = v

            def iterator(self):
                outer.made.append("legs")
                return iter(list(outer.legs.items()))

            def clear(self):
                outer.made.append("legs clear")
                outer.legs.clear()
        return Legs()

    def registerTimer(self, at):
        self.made.append("timer")
        self.timers.append(at)

    def deleteTimer(self, at):
        self.made.append("no timer")
        self.timers.remove(at)


class Clock:
    def __init__(self, ms):
        self.getCurrentProcessingTimeInMs = lambda: ms


def part(conn, seconds, event, start=True):
    at = str(seconds * 1_000_000 + keyed.TIME_BASE).zfill(keyed.TIME_WIDTH)
    folds = dict.fromkeys(n for kinds in keyed.kinds_of() for n in kinds) | {"c_start": at if start else None, "c_last": at, "l_events": "1", "l_connected": at}
    return {"part": json.dumps([conn, *folds.values()])}


def processor():
    calls, fold = Calls(), keyed.ContactState(*keyed.kinds_of(), DAY, 0)
    fold.init(calls)
    return calls, fold


def out(rows):
    return [json.loads(r.part) for r in rows]


def test_a_contact_that_is_due_at_once_is_not_held(spark):
    calls, fold = processor()
    rows = out(fold.handleInputRows(("a",), iter([part("k0", 10, 1), part("k1", 20, 2), part("k0", 30, 3)]), Clock(10**9)))
    assert calls.made == ["get"] and calls.value is None and not calls.timers
    assert [(r[0], r[1], r[-1]) for r in rows] == [("a", "k0", "abandoned"), ("a", "k1", "abandoned")]
    assert [int(r[-2]) for r in rows] == [2, 1]
    assert out(fold.handleInputRows(("b",), iter([part("k0", 10, 1, start=False)]), Clock(10**9))) == []
    assert calls.made == ["get"] * 2


def test_a_pending_contact_keeps_all_until_it_is_due(spark):
    calls, fold = processor()
    assert out(fold.handleInputRows(("a",), iter([part("k0", 10, 1), part("k1", 20, 2)]), Clock(50_000))) == []
    assert calls.made == ["get", "leg update", "leg update", "timer", "update"]
    assert calls.timers == [(10 + DAY) * 1000 + 1]
    # The timer fires only once its time lies before the clock's.
    assert out(fold.handleInputRows(("a",), iter([part("k1", 30, 3)]), Clock(calls.timers[0]))) == []
    rows = out(fold.handleInputRows(("a",), iter([part("k2", 40, 4)]), Clock(calls.timers[0] + 1)))
    assert [(r[1], int(r[-2]), r[-1]) for r in rows] == [("k0", 1, "abandoned"), ("k1", 2, "abandoned"), ("k2", 1, "abandoned")]
    assert calls.value is None and not calls.legs and not calls.timers


def test_a_timer_releases_what_is_held(spark):
    calls, fold = processor()
    list(fold.handleInputRows(("a",), iter([part("k0", 10, 1)]), Clock(50_000)))
    rows = out(fold.handleExpiredTimer(("a",), None, None))
    assert [(r[1], r[-1]) for r in rows] == [("k0", "abandoned")] and calls.value is None and not calls.legs
    assert out(fold.handleExpiredTimer(("a",), None, None)) == []
