"""Relational, star, dashboard and realtime queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import stored, views
from checks.registry import add
from tramline.plans import cards, realtime, relational, star

LABEL = (
    "CASE {c} WHEN 0 THEN 'Tranvía' WHEN 1 THEN 'Metro' WHEN 3 THEN 'Autobús' "
    "WHEN 7 THEN 'Funicular' ELSE 'Otro' END"
)


# --- relational: newest snapshot ------------------------------------------


def _a(plan):
    """On the stored history, with the operators' own choice of the newest snapshot."""
    return lambda spark, sf: plan(stored.relational_history(spark, sf))


add(
    "a01_top_routes",
    _a(relational.top_routes_by_trips),
    "SELECT r.route_short_name, r.route_long_name, count(*) AS num_viajes "
    "FROM n_trips t JOIN n_routes r ON t.route_id = r.route_id "
    "GROUP BY r.route_id, r.route_short_name, r.route_long_name "
    "ORDER BY num_viajes DESC, r.route_id LIMIT 10",
)
add(
    "a02_trips_by_transport",
    _a(relational.trips_by_transport),
    f"SELECT {LABEL.format(c='route_type')} AS tipo_transporte, count(*) AS num_viajes "
    "FROM n_routes JOIN n_trips USING (route_id) GROUP BY route_type",
)
add(
    "a03_top_stops",
    _a(relational.top_stops_by_calls),
    "SELECT s.stop_id, s.stop_name, count(c.trip_id) AS num_viajes "
    "FROM n_stop_times c JOIN n_stops s ON c.stop_id = s.stop_id GROUP BY 1, 2 "
    "ORDER BY 3 DESC, 1 LIMIT 10",
)
add(
    "a04_top_routes_by_stops",
    _a(relational.top_routes_by_stops),
    "SELECT route_short_name, route_long_name, count(DISTINCT c.stop_id) AS num_paradas "
    "FROM n_stop_times c JOIN n_trips t USING (trip_id) JOIN n_routes r USING (route_id) "
    "GROUP BY route_id, route_short_name, route_long_name "
    "ORDER BY num_paradas DESC, route_id LIMIT 10",
)
add(
    "a05_trips_by_direction",
    _a(relational.trips_by_direction),
    "SELECT direction_id, count(*) AS num_viajes FROM n_trips GROUP BY 1 "
    "ORDER BY 1 NULLS LAST",
)
add(
    "a06_calendar_exceptions",
    _a(relational.calendar_exceptions),
    "SELECT exception_type, count(*) AS num_registros FROM g_calendar_dates "
    "WHERE snapshot_date = (SELECT d FROM newest) GROUP BY 1",
)
add(
    "a07_top_services",
    _a(relational.top_services),
    "SELECT service_id, count(*) AS num_viajes FROM n_trips GROUP BY 1 "
    "ORDER BY 2 DESC, 1 LIMIT 10",
)


# --- star: whole history --------------------------------------------------


def _d(plan):
    return lambda spark, sf: plan(stored.lazy_star(spark, sf))


ROUTES = "s_trip t JOIN g_routes r USING (route_id, snapshot_date)"
CALLS = "s_call c JOIN g_routes r USING (route_id, snapshot_date)"

add(
    "d01_top_routes",
    _d(star.top_routes),
    "SELECT route_id, route_short_name, route_long_name, count(*) AS num_viajes "
    f"FROM {ROUTES} GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 10",
)
add(
    "d02_trips_by_route_type",
    _d(star.trips_by_route_type),
    f"SELECT route_type, count(*) AS num_viajes FROM {ROUTES} GROUP BY 1",
)
add(
    "d03_top_stops_by_calls",
    _d(star.top_stops_by_calls),
    "SELECT stop_id, stop_name, count(*) AS num_pasos "
    "FROM s_call JOIN g_stops USING (stop_id, snapshot_date) "
    "GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10",
)
_D04 = (
    "SELECT route_short_name, route_long_name, "
    "count(DISTINCT row(c.stop_id, c.snapshot_date)) AS num_paradas "
    f"FROM {CALLS} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"
)
add("d04_route_names_by_stops", _d(star.top_route_names_by_stops), _D04)
add(
    "d05_trips_by_direction",
    _d(star.trips_by_direction),
    "SELECT direction_id, count(*) AS num_viajes FROM s_trip GROUP BY 1",
)
add(
    "d06_top_services",
    _d(star.top_services),
    "SELECT service_id, count(*) AS num_viajes FROM s_trip GROUP BY 1 "
    "ORDER BY 2 DESC, 1 LIMIT 20",
)
add(
    "d07_routes_by_type",
    _d(star.routes_by_type),
    "SELECT route_type, count(*) AS num_rutas FROM g_routes GROUP BY 1",
)
add(
    "d08_top_route_service_pairs",
    _d(star.top_route_service_pairs),
    f"SELECT route_short_name, service_id, count(*) AS num_viajes FROM {ROUTES} "
    "GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10",
)
add(
    "d09_trips_by_route_direction",
    _d(star.trips_by_route_and_direction),
    f"SELECT route_short_name, direction_id, count(*) AS num_viajes FROM {ROUTES} "
    "GROUP BY 1, 2",
)
add(
    "d10_service_usage",
    _d(star.service_usage),
    "SELECT service_id, count(DISTINCT row(route_id, snapshot_date)) AS num_rutas, "
    "count(*) AS num_viajes FROM s_trip GROUP BY 1",
)
add(
    "d11_trips_by_weekday",
    _d(star.trips_by_weekday),
    " UNION ALL ".join(
        f"SELECT '{name}' AS dia_semana, count(*) AS num_viajes FROM s_trip "
        f"JOIN s_service USING (service_id, snapshot_date) WHERE {day} = 1"
        for day, name in (
            ("monday", "Lunes"),
            ("tuesday", "Martes"),
            ("wednesday", "Miércoles"),
            ("thursday", "Jueves"),
            ("friday", "Viernes"),
            ("saturday", "Sábado"),
            ("sunday", "Domingo"),
        )
    ),
)
add(
    "d12_top_stops_by_trips",
    _d(star.top_stops_by_trips),
    "SELECT stop_id, stop_name, count(DISTINCT row(trip_id, snapshot_date)) AS num_viajes "
    "FROM s_call JOIN g_stops USING (stop_id, snapshot_date) "
    "GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10",
)
add("d13_route_names_by_stops", _d(star.top_route_names_by_stops), _D04)
add(
    "d14_trips_by_route_service",
    _d(star.trips_by_route_and_service),
    f"SELECT route_short_name, service_id, count(*) AS num_viajes FROM {ROUTES} "
    "GROUP BY 1, 2",
)
add(
    "d15_stops_by_location_type",
    _d(star.stops_by_location_type),
    "SELECT location_type, count(*) AS num_paradas FROM g_stops GROUP BY 1",
)
add(
    "d16_stops_by_wheelchair",
    _d(star.stops_by_wheelchair),
    "SELECT wheelchair_boarding, count(*) AS num_paradas FROM g_stops GROUP BY 1",
)
add(
    "d17_route_workload",
    _d(star.route_workload),
    "SELECT route_short_name, route_long_name, "
    "count(DISTINCT row(trip_id, snapshot_date)) AS num_viajes, "
    f"count(*) AS num_paradas_recorridas FROM {CALLS} GROUP BY 1, 2 "
    "ORDER BY 3 DESC, 1, 2 LIMIT 20",
)
add(
    "d18_service_active_days",
    _d(star.service_active_days),
    "SELECT service_id, start_date, end_date, "
    + " + ".join(
        f"coalesce({d}, 0)"
        for d in (
            "monday",
            "tuesday",
            "wednesday",
            "thursday",
            "friday",
            "saturday",
            "sunday",
        )
    )
    + " AS dias_activos FROM s_service",
)
add(
    "d19_table_totals",
    _d(star.table_totals),
    "SELECT (SELECT count(*) FROM g_routes) AS total_rutas, "
    "(SELECT count(*) FROM g_stops) AS total_paradas, "
    "(SELECT count(*) FROM s_service) AS total_servicios, "
    "(SELECT count(*) FROM s_trip) AS total_viajes, "
    "(SELECT count(*) FROM s_call) AS total_stop_times",
)
add(
    "d20_model_totals",
    _d(star.model_totals),
    "SELECT count(DISTINCT row(trip_id, snapshot_date)) AS total_viajes, "
    "count(DISTINCT row(route_id, snapshot_date)) AS total_rutas, "
    "count(DISTINCT row(stop_id, snapshot_date)) AS total_paradas, "
    "count(DISTINCT row(service_id, snapshot_date)) AS total_servicios, "
    "count(*) AS total_stop_times FROM s_call",
)
add(
    "d21_top_routes_by_key",
    _d(star.top_routes_by_key),
    f"SELECT route_short_name, count(*) AS total_viajes FROM {ROUTES} "
    "GROUP BY route_id, snapshot_date, route_short_name "
    "ORDER BY total_viajes DESC, route_id, snapshot_date LIMIT 10",
)

# --- dashboard cards ------------------------------------------------------

LAST = "snapshot_date = (SELECT max(snapshot_date) FROM s_trip)"
add(
    "b01_trips_by_transport",
    _d(cards.trips_by_transport),
    f"SELECT {LABEL.format(c='route_type')} AS tipo_transporte, count(*) AS total_viajes "
    f"FROM {ROUTES} WHERE {LAST} GROUP BY route_type",
)
add(
    "b02_top_lines",
    _d(cards.top_lines),
    "SELECT route_short_name AS linea, route_long_name AS nombre_ruta, "
    f"count(*) AS total_viajes FROM {ROUTES} WHERE {LAST} "
    "GROUP BY route_id, route_short_name, route_long_name "
    "ORDER BY total_viajes DESC, route_id LIMIT 10",
)
add(
    "b03_total_trips",
    _d(cards.total_trips),
    f"SELECT count(*) AS total_viajes FROM s_trip WHERE {LAST}",
)
add(
    "b04_total_stops",
    _d(cards.total_stops),
    "SELECT count(*) AS total_paradas FROM g_stops "
    "WHERE snapshot_date = (SELECT max(snapshot_date) FROM g_stops)",
)
add(
    "b05_total_lines",
    _d(cards.total_lines),
    "SELECT count(*) AS total_lineas FROM g_routes "
    "WHERE snapshot_date = (SELECT max(snapshot_date) FROM g_routes)",
)
add(
    "b06_top_stops",
    _d(cards.top_stops),
    "SELECT stop_name AS parada, count(*) AS total_pasos "
    "FROM s_call JOIN g_stops USING (stop_id, snapshot_date) "
    "WHERE snapshot_date = (SELECT max(snapshot_date) FROM s_call) "
    "GROUP BY stop_id, stop_name ORDER BY total_pasos DESC, stop_id LIMIT 10",
)


# --- realtime -------------------------------------------------------------


def _r(plan):
    return lambda spark, sf: plan(views.arrivals(spark, sf), realtime.NEWEST)


add(
    "r01_arrivals_per_line",
    _r(realtime.arrivals_per_line),
    "SELECT line, count(*) AS total_llegadas FROM recent GROUP BY 1",
)
add(
    "r02_arrivals_per_minute",
    _r(realtime.arrivals_per_minute),
    "SELECT date_trunc('minute', event_timestamp) AS minuto, count(*) AS total_llegadas "
    "FROM recent GROUP BY 1",
)
add(
    "r03_waiting_time_per_line",
    _r(realtime.waiting_time_per_line),
    "SELECT line, round(avg(arrival_seconds), 6) AS media_segundos, "
    "min(arrival_seconds) AS minimo_segundos, max(arrival_seconds) AS maximo_segundos "
    "FROM recent GROUP BY 1",
)
add(
    "r04_busiest_stops",
    _r(realtime.busiest_stops),
    "SELECT stop_id, count(*) AS total_llegadas FROM recent GROUP BY 1 "
    "ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10",
)
add(
    "r05_current_state",
    _r(realtime.current_state),
    "SELECT count(*) AS total_llegadas, count(DISTINCT line) AS lineas_activas, "
    "count(DISTINCT stop_id) AS paradas_activas, "
    "round(avg(arrival_seconds), 6) AS media_segundos FROM recent",
)
AT = dt.datetime(2024, 1, 15, 12)
HOUR = (
    "SELECT * FROM arrivals WHERE event_timestamp >= TIMESTAMP '2024-01-15 11:00:00' "
    "AND event_timestamp <= TIMESTAMP '2024-01-15 12:00:00'"
)
for name, plan, sql in (
    (
        "r01_arrivals_per_line_at",
        realtime.arrivals_per_line,
        "SELECT line, count(*) AS total_llegadas FROM recent GROUP BY 1",
    ),
    (
        "r02_arrivals_per_minute_at",
        realtime.arrivals_per_minute,
        "SELECT date_trunc('minute', event_timestamp) AS minuto, count(*) AS total_llegadas "
        "FROM recent GROUP BY 1",
    ),
    (
        "r03_waiting_time_per_line_at",
        realtime.waiting_time_per_line,
        "SELECT line, round(avg(arrival_seconds), 6) AS media_segundos, "
        "min(arrival_seconds) AS minimo_segundos, max(arrival_seconds) AS maximo_segundos "
        "FROM recent GROUP BY 1",
    ),
    (
        "r04_busiest_stops_at",
        realtime.busiest_stops,
        "SELECT stop_id, count(*) AS total_llegadas FROM recent GROUP BY 1 "
        "ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10",
    ),
    (
        "r05_current_state_at",
        realtime.current_state,
        "SELECT count(*) AS total_llegadas, count(DISTINCT line) AS lineas_activas, "
        "count(DISTINCT stop_id) AS paradas_activas, "
        "round(avg(arrival_seconds), 6) AS media_segundos FROM recent",
    ),
):
    add(name, lambda spark, sf, p=plan: p(views.arrivals(spark, sf), AT), sql, recent=HOUR)
add(
    "r06_newest_snapshot",
    _d(realtime.newest_snapshot_summary),
    "SELECT snapshot_date, count(*) AS total_viajes, "
    "count(DISTINCT route_id) AS total_rutas, count(DISTINCT service_id) AS total_servicios "
    f"FROM s_trip WHERE {LAST} GROUP BY 1",
)
add(
    "r07_latest_arrivals",
    lambda spark, sf: realtime.latest_arrivals(views.arrivals(spark, sf)),
    "SELECT * FROM arrivals ORDER BY event_timestamp DESC, line NULLS LAST, "
    "stop_id NULLS LAST, route_id NULLS LAST, arrival_seconds NULLS LAST LIMIT 20",
)
add(
    "r07_all_arrivals_per_line",
    lambda spark, sf: realtime.all_arrivals_per_line(views.arrivals(spark, sf)),
    "SELECT line, count(*) AS total_llegadas FROM arrivals GROUP BY 1",
)
