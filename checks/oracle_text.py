"""Assembling an oracle query from the views it uses."""

from __future__ import annotations

import re

from checks.views import ctes

VIEWS = ctes() | {
    # The star schema by natural keys; surrogate key values are never compared.
    "s_service": (
        "SELECT * FROM g_calendar UNION ALL "
        "SELECT DISTINCT x.service_id, CAST(NULL AS INT), CAST(NULL AS INT), "
        "CAST(NULL AS INT), CAST(NULL AS INT), CAST(NULL AS INT), CAST(NULL AS INT), "
        "CAST(NULL AS INT), CAST(NULL AS DATE), CAST(NULL AS DATE), x.snapshot_date "
        "FROM g_calendar_dates x "
        "WHERE EXISTS (SELECT 1 FROM g_trips t WHERE t.service_id = x.service_id "
        "AND t.snapshot_date = x.snapshot_date) "
        "AND NOT EXISTS (SELECT 1 FROM g_calendar c WHERE c.service_id = x.service_id "
        "AND c.snapshot_date = x.snapshot_date)"
    ),
    "s_trip": (
        "SELECT t.* FROM g_trips t "
        "SEMI JOIN g_routes r USING (route_id, snapshot_date) "
        "SEMI JOIN s_service v USING (service_id, snapshot_date)"
    ),
    "s_call": (
        "SELECT c.*, t.route_id, t.service_id FROM g_stop_times c "
        "JOIN s_trip t USING (trip_id, snapshot_date) "
        "SEMI JOIN g_stops p USING (stop_id, snapshot_date)"
    ),
    "newest": "SELECT max(snapshot_date) AS d FROM g_trips",
    "n_trips": "SELECT * FROM g_trips WHERE snapshot_date = (SELECT d FROM newest)",
    "n_routes": "SELECT * FROM g_routes WHERE snapshot_date = (SELECT d FROM newest)",
    "n_stops": "SELECT * FROM g_stops WHERE snapshot_date = (SELECT d FROM newest)",
    "n_stop_times": (
        "SELECT * FROM g_stop_times WHERE snapshot_date = (SELECT d FROM newest)"
    ),
    "recent": (
        "SELECT * FROM arrivals WHERE event_timestamp >= "
        "(SELECT max(event_timestamp) FROM arrivals) - INTERVAL 1 HOUR"
    ),
}


def with_views(query: str, **extra: str) -> str:
    """The query with every view it mentions, directly or not, as a leading CTE."""
    known = VIEWS | extra
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z_]+\b", text):
            if name in known and name not in order:
                visit(known[name])
                order.append(name)

    visit(query)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order) + "\n" + query
