"""Random sequences through the pieces that run inside tasks, without a session."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from framewise.operators import units
from framewise.operators.tracking import DETECTION, FRAME
from framewise.streaming import streak
from framewise.streaming.occurrence import NthOccurrence, _first_rows
from framewise.streaming.streak import JointStreak, _block_summary
from framewise.streaming.tracking import _ROW, FaceTracker
from tests import brute, tracker_sql


class Value:
    """A value state that only remembers."""

    def __init__(self):
        self.stored = None

    def get(self):
        return self.stored

    def update(self, value):
        self.stored = value


def _rows(pdf):
    return pdf.to_dict("records")


@settings(deadline=None, max_examples=60)
@given(
    st.lists(st.lists(st.booleans(), max_size=40), min_size=1, max_size=4),
    st.integers(1, 12),
    st.integers(1, 15),
)
def test_occurrence_pieces(batches, n, chunk):
    keys, order = ["id", "emotion"], ["frame", "pos"]
    states = {e: NthOccurrence(keys, order, n, None) for e in ("A", "B")}
    for state in states.values():
        state.count = Value()
    frame, people, got = 0, [], []
    for batch in batches:
        data = []
        for first in batch:
            data.append((frame, 0, 1, "A" if first else "B"))
            frame += 1
        people += data
        data = data[::-1]
        pdf = pd.DataFrame(data, columns=["frame", "pos", "id", "emotion"])
        chunks = [pdf[i : i + chunk] for i in range(0, len(pdf), chunk)]
        reduced = list(_first_rows(keys, order, n)(iter(chunks)))
        for emotion, state in states.items():
            mine = [r for part in reduced for r in _rows(part[part.emotion == emotion])]
            if mine:
                got += [tuple(r) for r in state.handleInputRows((1, emotion), iter(mine), None)]
    assert sorted(got) == sorted(brute.nth(people, n))


@settings(deadline=None, max_examples=100)
@given(
    st.lists(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=30), min_size=1, max_size=4),
    st.integers(0, 6),
    st.integers(1, 9),
    st.sampled_from([0, 2, 1000]),
)
def test_streak_pieces(batches, over, span, few):
    streak._FEW = few
    keys, order, names = ["id"], ["frame", "pos"], ["a", "b"]
    state = JointStreak(keys, order, names, over, None)
    state.counters = Value()
    frame, people, got = 0, [], []
    for batch in batches:
        blocks = {}
        for a, b in batch:
            blocks.setdefault(frame // span, []).append((1, frame, 0, frame // span, a, b))
            people.append((frame, 0, 1, a, b))
            frame += 1
        pieces = []
        for data in blocks.values():
            pdf = pd.DataFrame(data[::-1], columns=["id", "frame", "pos", "_block", "_ok_a", "_ok_b"])
            pieces += _rows(_block_summary(keys, order, names, over)(pdf))
        for lane in {p["_lane"] for p in pieces}:
            mine = [p for p in pieces if p["_lane"] == lane]
            got += [tuple(r) for r in state.handleInputRows((1, lane), iter(mine[::-1]), None)]
    expected = [r[:3] for r in brute.lengths(people) if r[3] > over and r[4] > over]
    assert sorted(got) == sorted(expected)


class Handle:
    """State that only remembers; what is stored must be as plain as its schema."""

    def __init__(self):
        self.stored = {}

    def getValueState(self, name, schema, ttl=None):
        return self.stored.setdefault(name, Value())

    def getMapState(self, name, key_schema, schema, ttl=None):
        return self.stored.setdefault(name, Entries())

    def getListState(self, name, schema, ttl=None):
        return self.stored.setdefault(name, Rows())


class Entries(dict):
    def iterator(self):
        return iter(list(self.items()))

    def updateValue(self, key, value):
        assert all(type(v) in (int, bool, str, type(None)) for v in value)
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Rows(list):
    def get(self):
        return iter(list(self))

    def put(self, rows):
        self[:] = rows

    def appendList(self, rows):
        self.extend(rows)


def _box(frame, at, x, y):
    """A step of a box of 60 by 60 px, as INPUT and BOX have it, without the camera."""
    return (frame, DETECTION, at, x, y, 60, 60, 0, 0, None, x + 30, y + 30, max(x - 9, 0), max(y - 9, 0), x + 69, y + 69)


@settings(deadline=None, max_examples=60)
@given(
    st.lists(
        st.tuples(st.sampled_from([0, 1, 1, 1, 2, 30, 61, 62, 63]), st.integers(0, 40), st.integers(0, 4)),
        max_size=40,
    ),
    st.lists(st.integers(0, 3000), max_size=4),
    st.booleans(),
)
def test_tracker(moves, cuts, whole_frames):
    frame, at, steps = 0, 0, []
    for ahead, x, y in moves:
        at = at + 1 if ahead == 0 else 0
        frame += ahead
        steps.append(_box(frame, at, x * 15, y * 15))
    steps += [(f, FRAME, 0, 0, 0, 0, 0, 0, 0, None, 0, 0, 0, 0, 0, 0) for f in range(frame + 80)]
    steps.sort(key=lambda s: s[:3])
    # State is saved and restored anywhere; without whole frames, between two frames.
    cuts = sorted({c % len(steps) for c in cuts})
    if not whole_frames:
        cuts = [next(i for i, s in enumerate(steps) if s[0] == steps[c][0]) for c in cuts]
    state, found = Handle(), []
    for begin, end in zip([0, *cuts], [*cuts, len(steps)], strict=True):
        tracker = FaceTracker(False, None, whole_frames, None)
        tracker.init(state)
        part = pd.DataFrame(steps[begin:end][::-1], columns=_ROW)
        for shown in tracker.handleInputRows((0,), iter([part] if len(part) else [part.iloc[:0]]), None) if len(part) else ():
            for r in shown.to_dict("records"):
                found += [(f, r["session"], r["n"], r["track_id"], r["x"], r["y"], r["last_seen_frame"], r["ask"] and f == r["frames"][0]) for f in r["frames"]]
    columns = ["frame", "session", "n", "track_id", "x", "y", "last_seen_frame", "ask"]
    want = tracker_sql.tracks([(0, *s[:1], *s[2:7]) for s in steps if s[1] == DETECTION], [(0, f) for f in range(frame + 80)], columns)
    last = frame + 79 if whole_frames else None
    assert sorted(found) == [r for r in want if r[0] != last]
    # Only live tracks and the open frame are kept.
    assert len(state.stored["tracks"]) <= len([r for r in want if r[0] >= frame + 18]) + len(moves)
    if whole_frames:
        assert {r[0] for r in state.stored["open_frame"]} == {frame + 79}


@settings(deadline=None, max_examples=150)
@given(st.lists(st.tuples(st.integers(-900, 900), st.integers(0, 12), st.integers(0, 6)), max_size=60), st.integers(1, 6), st.lists(st.integers(-15, 15), max_size=3))
def test_units(places, span, whole):
    """Parts of blocks, linked over borders, against components of touching cells found in one go."""
    import pyarrow as pa

    before, units.BLOCK_SLABS = units.BLOCK_SLABS, span
    try:
        cells = sorted({(f // units.SLAB, None if f // units.SLAB in whole else x, None if f // units.SLAB in whole else y) for f, x, y in places}, key=str)
        blocks = {}
        for c in cells:
            blocks.setdefault(c[0] // span, []).append(c)
        parted = []
        for block, rows in blocks.items():
            table = pa.table({"slab": [c[0] for c in rows], "cell_x": pa.array([c[1] for c in rows], pa.int64()), "cell_y": pa.array([c[2] for c in rows], pa.int64())})
            parted += [{"camera_id": 1, "block": block, **r} for r in units._with_parts(table).to_pylist()]
        edges = [r for r in parted if r["slab"] % span in (0, span - 1)]
        links = {}
        if edges:
            links = {(r["block"], r["part"]): (r["unit_block"], r["unit_part"]) for r in units._linked(pa.Table.from_pylist(edges)).to_pylist()}
        got = {(r["slab"], r["cell_x"], r["cell_y"]): links.get((r["block"], r["part"]), (r["block"], r["part"])) for r in parted}
    finally:
        units.BLOCK_SLABS = before
    near = lambda a, b: abs(a[0] - b[0]) <= 1 and (a[1] is None or b[1] is None or (abs(a[1] - b[1]) <= 1 and abs(a[2] - b[2]) <= 1))
    want = {c: i for i, c in enumerate(cells)}
    changed = True
    while changed:
        changed = False
        for a in cells:
            for b in cells:
                if near(a, b) and want[a] != want[b]:
                    want[a] = want[b] = min(want[a], want[b])
                    changed = True
    assert {(got[a] == got[b]) == (want[a] == want[b]) for a in cells for b in cells} <= {True}


def test_state_grows_with_live_tracks_only():
    """Fifty micro-batches in which faces come and go: an entry for each that lives, and the open frame's rows."""
    state = Handle()
    for batch in range(50):
        steps = []
        for frame in range(batch * 100, batch * 100 + 100):
            # Two faces that stay, and one that is there for ten frames, at another place each time.
            steps += [_box(frame, 0, 0, 0), _box(frame, 1, 200, 0)]
            if frame % 100 < 10:
                steps.append(_box(frame, 2, 400 + batch % 2 * 150, 0))
            steps.append((frame, FRAME, 0, 0, 0, 0, 0, 0, 0, None, 0, 0, 0, 0, 0, 0))
        tracker = FaceTracker(False, None, True, None)
        tracker.init(state)
        for _ in tracker.handleInputRows((0,), iter([pd.DataFrame(steps, columns=_ROW)]), None):
            pass
        # The third face was last seen 88 frames before the last closed one.
        assert len(state.stored["tracks"]) == 2 and len(state.stored["open_frame"]) == 3
    assert state.stored["camera"].get()[2] == 2 + 50
