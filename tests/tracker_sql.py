"""Tracks without label results by the SQL of the registered queries, over any detections."""

import duckdb

import __spark_entry__ as driver

_STEPS = ("boxes", "steps", "starts", "assigned", "numbered", "shown", "tracks")


def _values(rows, width):
    if not rows:
        return f"SELECT {', '.join(['0'] * width)} WHERE false"
    return "VALUES " + ", ".join(str(tuple(r)) for r in rows)


def tracks(detections, listed, columns):
    """detections: (camera, frame, det_ord, x, y, w, h); listed: (camera, frame) to show, detected ones are anyway."""
    shown = sorted({*listed, *[d[:2] for d in detections]})
    con = duckdb.connect()
    types = "camera_id BIGINT, frame BIGINT"
    con.execute(f"CREATE TABLE detections ({types}, det_ord INT, x INT, y INT, w INT, h INT, verified BOOLEAN)")
    con.execute(f"CREATE TABLE camera_frames ({types})")
    con.execute(f"INSERT INTO detections SELECT *, true FROM ({_values(detections, 7)})")
    con.execute(f"INSERT INTO camera_frames {_values(shown, 2)}")
    return sorted(con.execute(driver._sql(f"SELECT {', '.join(columns)} FROM tracks", *_STEPS)).fetchall())
