"""Generated activity calendars against a plain-Python model of the label
definitions (new / retained / resurrected / churned at the missed period)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import ev, raw_frame
from tidemark.plans.models import Models

BASE = dt.date(2023, 11, 20)


def _start(d: dt.date, grain: str) -> dt.date:
    if grain == "day":
        return d
    if grain == "week":
        return d - dt.timedelta(days=d.weekday())
    return d.replace(day=1)


def _next(s: dt.date, grain: str) -> dt.date:
    if grain == "day":
        return s + dt.timedelta(days=1)
    if grain == "week":
        return s + dt.timedelta(days=7)
    return (s.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def model_labels(activity: dict[str, list[dt.date]]) -> set:
    out = set()
    for user, days in activity.items():
        for grain in ("day", "week", "month"):
            periods = sorted({_start(d, grain) for d in days})
            active = set(periods)
            for i, p in enumerate(periods):
                if i == 0:
                    label = "new"
                elif periods[i - 1] == _prev(p, grain):
                    label = "retained"
                else:
                    label = "resurrected"
                out.add((user, grain, p, label))
                nxt = _next(p, grain)
                if nxt not in active:
                    out.add((user, grain, nxt, "churned"))
    return out


def _prev(s: dt.date, grain: str) -> dt.date:
    if grain == "day":
        return s - dt.timedelta(days=1)
    if grain == "week":
        return s - dt.timedelta(days=7)
    return (s - dt.timedelta(days=1)).replace(day=1)


calendars = st.dictionaries(
    keys=st.sampled_from(["u1", "u2", "u3", "u4"]),
    values=st.lists(st.integers(min_value=0, max_value=120), min_size=1, max_size=12),
    min_size=1, max_size=4,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(calendars)
def test_labels_match_python_model(spark, cal):
    activity = {u: [BASE + dt.timedelta(days=o) for o in offs] for u, offs in cal.items()}
    rows = [ev(f"{d.isoformat()} 12:00:00", u) for u, days in activity.items() for d in days]
    got = {(r.user_id, r.period_grain, r.period_start, r.cohort_type)
           for r in Models(raw=raw_frame(spark, rows)).growth_classified.collect()}
    assert got == model_labels(activity)
