"""Silver, quarantine and gold against a plain Python model on random small batches."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daymark.operators import screening
from daymark.operators.daily_metrics import daily_user_metrics
from daymark.operators.dedup import dedup_events
from daymark.schemas import EVENT_COLUMNS, EVENT_TYPES, PAGES
from helpers import INGEST_DATE, events_df

some = st.sampled_from
an_event = st.fixed_dictionaries(
    {
        "event_id": some([None, "a", "b", "c"]),
        "user_id": some(["1", "2", "x", None]),
        "event_type": some([*EVENT_TYPES, "Login", None]),
        "event_timestamp": some(
            ["2024-01-05T00:00:01+00:00", "2024-01-05T23:00:00-05:00", "2024-01-06T00:00:00Z", "oops", None]
        ),
        "page": some(["/", "/cart", "/admin", None]),
        "product_id": some(["1001", None]),
        "amount": some(["1.5", "2.25", "ten", None]),
        "error_code": st.none(),
        "source": st.just("web_app"),
    }
)


def day(e):
    text = e["event_timestamp"]
    return INGEST_DATE if text in (None, "oops") else text[:10]


def model(events):
    copies, kept = defaultdict(list), []
    for e in events:
        (kept if e["event_id"] is None else copies[e["event_id"], day(e)]).append(e)
    rank = lambda e: [(e[c] is None, e[c] or "") for c in ("event_timestamp", *EVENT_COLUMNS)]
    kept += [min(same, key=rank) for same in copies.values()]
    silver, reasons, gold = [], [], defaultdict(lambda: [0, None])
    for e in kept:
        if e["user_id"] not in ("1", "2"):
            reasons.append("bad_user_id")
        elif e["event_type"] not in EVENT_TYPES:
            reasons.append("bad_event_type")
        elif e["page"] not in PAGES:
            reasons.append("bad_page")
        elif e["event_timestamp"] == "oops":
            reasons.append("bad_event_timestamp")
        else:
            silver.append((str(e["event_id"]), day(e), int(e["user_id"]), e["event_type"], e["amount"]))
            metric = gold[day(e), int(e["user_id"])]
            metric[0] += 1
            if e["amount"] in ("1.5", "2.25"):
                metric[1] = (metric[1] or 0) + float(e["amount"])
    return sorted(map(str, silver)), sorted(reasons), sorted((*k, *v) for k, v in gold.items())


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(an_event, max_size=12))
def test_tables_follow_the_model(spark, events):
    once = dedup_events(events_df(spark, *events).repartition(3))
    silver, reasons, gold = model(events)
    ours = screening.clean(once)
    numbers = {1.5: "1.5", 2.25: "2.25"}
    got = [
        (str(r.event_id), str(r.event_date), r.user_id, r.event_type, numbers.get(r.amount)) for r in ours.collect()
    ]
    expected = [s.replace("'ten'", "None") for s in silver]
    assert sorted(map(str, got)) == sorted(expected)
    assert sorted(r.reason for r in screening.quarantine(once).collect()) == reasons
    metrics = daily_user_metrics(ours).collect()
    assert sorted((str(r.event_date), r.user_id, r.events_count, r.total_amount) for r in metrics) == gold
