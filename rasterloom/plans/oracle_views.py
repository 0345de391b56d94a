"""The fixture views again, as SQL text for the oracle."""

from __future__ import annotations

# name -> (views it needs, body)
VIEWS = {
    # One row per velocity field.
    "fields": ((), """
        SELECT *, 'R' || orbit1 || '_R' || orbit2 AS orbit_pair,
               CASE WHEN orbit1 = orbit2 THEN 1 ELSE 0 END AS orbit_match
        FROM (SELECT vec_id AS field_id, '00' || (vec_id % 4) || '_Site' AS region,
                     CAST(label AS INTEGER) AS orbit1,
                     CAST(CASE WHEN vec_id % 50 = 7 THEN (label + 5) % 10
                               WHEN vec_id % 2 = 0 THEN label ELSE (label + 1) % 10 END AS INTEGER) AS orbit2,
                     CAST(-(1 + vec_id % 10) AS DOUBLE) AS day_sep
              FROM embeddings)"""),
    "px": ((), """
        SELECT '00' || (field_id % 4) || '_Site' AS region, field_id,
               CASE WHEN p < 32 THEN 'dx' ELSE 'dy' END AS component,
               CAST((p % 32) // 4 AS INTEGER) AS iy, CAST(p % 4 AS INTEGER) AS ix,
               CASE WHEN abs(e) < 0.004 THEN NULL ELSE round(CAST(e AS DOUBLE) * 10, 6) END AS value
        FROM (SELECT vec_id AS field_id, unnest(embedding) AS e,
                     generate_subscripts(embedding, 1) - 1 AS p FROM embeddings)"""),
    "pw": (("px",), """
        SELECT region, field_id, iy, ix, max(value) FILTER (component = 'dx') AS dx,
               max(value) FILTER (component = 'dy') AS dy
        FROM px GROUP BY ALL"""),
    "cells": ((), """
        SELECT CAST(y AS INTEGER) AS iy, CAST(x AS INTEGER) AS ix
        FROM range(8) t(y), range(4) u(x)"""),
    "masks": (("cells",), """
        SELECT '00' || r || '_Site' AS region, iy, ix, (iy + ix) % 3 <> 0 AS is_ice,
               (ix = 0 AND iy < 2) AS is_ocean,
               (iy + ix) % 3 = 0 AND NOT (ix = 0 AND iy < 2) AS is_rock
        FROM cells, (SELECT DISTINCT vec_id % 4 AS r FROM embeddings)"""),
    # Speed, dx and dy of every field, as three rasters.
    "px3": (("pw",), """
        SELECT region, field_id, 'dmag' AS component, iy, ix, sqrt(dx*dx + dy*dy) AS value FROM pw
        UNION ALL SELECT region, field_id, 'dx', iy, ix, dx FROM pw
        UNION ALL SELECT region, field_id, 'dy', iy, ix, dy FROM pw"""),
    "near": (("cells",), """
        SELECT c.iy, c.ix, least(greatest(c.iy + a.d, 0), 7) AS ny, least(greatest(c.ix + b.d, 0), 3) AS nx
        FROM cells c, (VALUES (-1), (0), (1)) a(d), (VALUES (-1), (0), (1)) b(d)"""),
    "smooth": (("px3", "near", "fields"), """
        SELECT c.region, c.field_id, c.component, c.iy, c.ix,
               CASE WHEN max(c.value) IS NOT NULL THEN median(n.value) END AS value
        FROM px3 c JOIN fields f ON f.field_id = c.field_id AND f.orbit_match = 1
        JOIN near k ON k.iy = c.iy AND k.ix = c.ix
        JOIN px3 n ON n.field_id = c.field_id AND n.component = c.component AND n.iy = k.ny AND n.ix = k.nx
        GROUP BY ALL"""),
    "raw_composite": (("smooth",), """
        SELECT region, component, iy, ix, median(value) AS value FROM smooth GROUP BY ALL"""),
    "a_priori": (("raw_composite", "near"), """
        SELECT c.region, c.component, c.iy, c.ix,
               CASE WHEN max(c.value) IS NOT NULL THEN median(n.value) END AS value
        FROM raw_composite c JOIN near k ON k.iy = c.iy AND k.ix = c.ix
        JOIN raw_composite n ON n.region = c.region AND n.component = c.component AND n.iy = k.ny AND n.ix = k.nx
        GROUP BY ALL"""),
    "flow": (("a_priori",), """
        SELECT region, iy, ix, CASE WHEN angle > 180 THEN angle - 360 ELSE angle END AS flow_ref
        FROM (SELECT region, iy, ix, CASE WHEN dx > 0 THEN base ELSE base + 180 END AS angle
              FROM (SELECT region, iy, ix, dx, CASE WHEN dx <> 0 THEN degrees(atan(dy / dx))
                           WHEN dy > 0 THEN 90.0 WHEN dy < 0 THEN -90.0 END AS base
                    FROM (SELECT region, iy, ix, max(value) FILTER (component = 'dx') AS dx,
                                 max(value) FILTER (component = 'dy') AS dy
                          FROM a_priori GROUP BY ALL)))"""),
    "eligible": (("fields",), """
        SELECT f.* FROM fields f JOIN (SELECT region, orbit_pair FROM fields GROUP BY ALL HAVING count(*) >= 5) k
        USING (region, orbit_pair)"""),
    "offsets": (("px", "eligible", "a_priori"), """
        SELECT e.region, e.orbit_pair, p.component, p.iy, p.ix,
               median((a.value - p.value) * e.day_sep) AS offset
        FROM px p JOIN eligible e ON e.field_id = p.field_id
        JOIN a_priori a ON a.region = p.region AND a.component = p.component AND a.iy = p.iy AND a.ix = p.ix
        GROUP BY ALL"""),
    "off_wide": (("offsets",), """
        SELECT region, orbit_pair, iy, ix, max("offset") FILTER (component = 'dx') AS dx_offset,
               max("offset") FILTER (component = 'dy') AS dy_offset
        FROM offsets GROUP BY ALL"""),
    "cor": (("pw", "fields", "off_wide"), """
        SELECT w.region, w.field_id, f.orbit_pair, f.day_sep, w.iy, w.ix, w.dx AS dx_raw,
               w.dx + o.dx_offset / f.day_sep AS dx, w.dy + o.dy_offset / f.day_sep AS dy
        FROM pw w JOIN fields f ON f.field_id = w.field_id
        JOIN off_wide o ON o.region = w.region AND o.orbit_pair = f.orbit_pair AND o.iy = w.iy AND o.ix = w.ix"""),
    "errors": (("cor", "masks"), """
        SELECT c.region, c.field_id,
               sqrt(avg(dx*dx + dy*dy)) AS mag_rmse, avg(dx) AS dx_mean, stddev_pop(dx) AS dx_sd,
               avg(dy) AS dy_mean, stddev_pop(dy) AS dy_sd,
               sqrt(avg((dx*dx + dy*dy) * day_sep * day_sep)) AS mag_displacement_rmse,
               avg(dx * day_sep) AS dx_displacement_mean, stddev_pop(dx * day_sep) AS dx_displacement_sd,
               avg(dy * day_sep) AS dy_displacement_mean, stddev_pop(dy * day_sep) AS dy_displacement_sd
        FROM cor c JOIN masks m ON m.region = c.region AND m.iy = c.iy AND m.ix = c.ix AND m.is_rock
        GROUP BY ALL"""),
    "angled": (("cor", "masks", "flow"), """
        SELECT *, CASE WHEN abs(flow_ref - dir) > 180 THEN 360 - abs(flow_ref - dir)
                       ELSE abs(flow_ref - dir) END AS flow_diff
        FROM (SELECT *, CASE WHEN angle > 180 THEN angle - 360 ELSE angle END AS dir
              FROM (SELECT *, CASE WHEN dx_raw > 0 THEN base ELSE base + 180 END AS angle
                    FROM (SELECT c.*, m.is_ice, m.is_rock, f.flow_ref,
                                 CASE WHEN dx <> 0 THEN degrees(atan(dy / dx))
                                      WHEN dy > 0 THEN 90.0 WHEN dy < 0 THEN -90.0 END AS base
                          FROM cor c JOIN masks m ON m.region = c.region AND m.iy = c.iy AND m.ix = c.ix
                          LEFT JOIN flow f ON f.region = c.region AND f.iy = c.iy AND f.ix = c.ix)))"""),
    "filtered": (("angled",), """
        SELECT region, field_id, iy, ix, is_ice,
               CASE WHEN is_ice AND flow_diff > 20 THEN NULL WHEN dy IS NULL THEN dx ELSE dx END AS vx,
               CASE WHEN dx IS NULL OR (is_ice AND flow_diff > 20) THEN NULL ELSE dy END AS vy
        FROM angled"""),
    "coverage": (("filtered",), """
        SELECT region, field_id, count(*) FILTER (is_ice) AS ice_cells,
               count(vx) FILTER (is_ice) AS valid_ice_cells
        FROM filtered GROUP BY ALL"""),
    "scenes": ((), """
        SELECT event_id, ts, tile,
               'S2' || CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END || '_MSIL2A_'
               || strftime(ts, '%Y%m%dT%H%M%S') || '_N0' || (200 + user_id % 5)
               || '_R' || lpad(CAST(1 + user_id % 143 AS VARCHAR), 3, '0') || '_T' || tile AS name,
               (event_type = 'purchase' OR value < 10) AS is_done
        FROM (SELECT *, CASE event_type WHEN 'view' THEN '22VFP' WHEN 'click' THEN '24WWU'
                         WHEN 'error' THEN '24WWV' WHEN 'signup' THEN '26XMR' ELSE '25WDS' END AS tile
              FROM events)"""),
    "scene_cols": (("scenes",), """
        SELECT event_id, ts, tile, name, is_done, tile AS region, substr(name, 1, 3) AS satellite,
               substr(name, 12, 15) AS datetime, substr(name, 12, 11) AS datehour,
               substr(name, 35, 3) AS orbits, substr(name, 29, 4) AS processing_baselines
        FROM scenes"""),
    # Scene n is paired with scene n + 97.
    "pairs": (("scene_cols",), """
        SELECT a.region, a.event_id, a.ts AS ts1, b.ts AS ts2, a.name AS scene1, b.name AS scene2,
               a.datehour AS dh1, b.datehour AS dh2, a.datetime AS dt1, b.datetime AS dt2,
               'vmap_' || a.satellite || '_MSIL2A_' || a.datehour || '_' || b.satellite || '_MSIL2A_'
               || b.datehour AS id
        FROM scene_cols a JOIN scene_cols b ON b.event_id = a.event_id + 97"""),
    "orbit_hours": (("scene_cols",), """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region, datehour
                       ORDER BY datetime DESC, satellite DESC, orbits DESC, processing_baselines DESC) AS k FROM scene_cols)
        WHERE k = 1"""),
    "reg": ((), """
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || '_' || n_name AS region, n_nationkey AS k,
               CAST(100 * (n_nationkey + 1) AS DOUBLE) AS area_km2,
               CAST((n_nationkey % 5) * 3000 AS DOUBLE) AS xmin,
               CAST((n_nationkey // 5) * 3000 AS DOUBLE) AS ymin,
               CAST((n_nationkey % 5) * 3000 + 3000 + 300 * (n_nationkey % 4) AS DOUBLE) AS xmax,
               CAST((n_nationkey // 5) * 3000 + 3000 AS DOUBLE) AS ymax,
               CASE n_nationkey % 3 WHEN 0 THEN '22VFP,24WWU' WHEN 1 THEN '24WWV'
                    ELSE '26XMR,25WDS' END AS utm_grid
        FROM nation"""),
    "tiles": (("reg",), """
        SELECT region, unnest(string_split(utm_grid, ',')) AS tile,
               generate_subscripts(string_split(utm_grid, ','), 1) - 1 AS rank
        FROM reg"""),
    "foot": ((), """
        SELECT c_custkey AS scene_no, CAST((c_custkey % 50) * 300 - 600 AS DOUBLE) AS x0,
               CAST(((c_custkey // 50) % 50) * 300 - 600 AS DOUBLE) AS y0,
               CAST((c_custkey % 50) * 300 - 600 + 1500 + (c_custkey % 7) * 300 AS DOUBLE) AS x1,
               CAST(((c_custkey // 50) % 50) * 300 - 600 + 1500 AS DOUBLE) AS y1
        FROM customer"""),
    "meets": (("foot", "reg"), """
        SELECT f.scene_no, r.region,
               (greatest(0, least(x1, xmax) - greatest(x0, xmin)) * greatest(0, least(y1, ymax) - greatest(y0, ymin)))
               / ((xmax - xmin) * (ymax - ymin)) AS frac
        FROM foot f JOIN reg r ON f.x0 <= r.xmax AND f.x1 >= r.xmin AND f.y0 <= r.ymax AND f.y1 >= r.ymin"""),
    "cat": ((), """
        SELECT event_id, ts, user_id, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS cloud_cover,
               CASE event_id % 8 WHEN 0 THEN 'LANDSAT_1' WHEN 1 THEN 'LANDSAT_3' WHEN 2 THEN 'LANDSAT_4'
                    WHEN 3 THEN 'LANDSAT_5' WHEN 4 THEN 'LANDSAT_7' WHEN 5 THEN 'LANDSAT_8'
                    WHEN 6 THEN 'LANDSAT_9' ELSE 'LANDSAT_2' END AS platform,
               CASE WHEN event_id % 3 = 0 THEN 'MSS' ELSE 'TM' END AS instrument,
               lpad(CAST(user_id AS VARCHAR), 6, '0') AS path_row,
               'SC' || event_id AS scene_id, 'item-' || event_id AS id,
               strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS datetime
        FROM events"""),
    "times": (("fields",), """
        SELECT *, t1 + to_hours(CAST(-day_sep * 24 AS BIGINT)) AS t2, t1 + to_hours(CAST(-day_sep * 12 AS BIGINT)) AS mid,
               '00' || (field_id % 4) || '_Site_' || strftime(t1, '%Y%m%dT%H%M%S') || '_'
               || strftime(t1 + to_hours(CAST(-day_sep * 24 AS BIGINT)), '%Y%m%dT%H%M%S') AS stem,
               CASE WHEN field_id % 3 = 0 THEN 'S2A' ELSE 'S2B' END AS satellite1,
               CASE WHEN field_id % 5 = 0 THEN 'S2A' ELSE 'S2B' END AS satellite2,
               '02' || lpad(CAST(field_id % 15 AS VARCHAR), 2, '0') AS processingbaseline1, '0214' AS processingbaseline2
        FROM (SELECT *, TIMESTAMP '2020-01-01' + to_hours(CAST(field_id AS BIGINT)) AS t1 FROM fields)"""),
    # What the document of a corrected field says.
    "docs": (("times", "errors", "coverage"), """
        SELECT t.field_id, t.region, 'S2_' || t.stem AS id, t.t1, t.t2, t.mid, round_even(-t.day_sep, 2) AS baseline_days,
               satellite1 AS scene_1_satellite, satellite2 AS scene_2_satellite, orbit1 AS scene_1_orbit, orbit2 AS scene_2_orbit,
               processingbaseline1 AS scene_1_processing_version, processingbaseline2 AS scene_2_processing_version,
               round_even(c.valid_ice_cells * 100.0 / c.ice_cells, 2) AS percent_ice_area_notnull,
               round_even(mag_rmse, 2) AS error_mag_rmse, round_even(dx_mean, 2) + 0 AS error_dx_mean, round_even(dx_sd, 2) AS error_dx_sd,
               round_even(dy_mean, 2) + 0 AS error_dy_mean, round_even(dy_sd, 2) AS error_dy_sd
        FROM times t JOIN errors e ON e.field_id = t.field_id JOIN coverage c ON c.field_id = t.field_id
        WHERE c.valid_ice_cells > 0 AND c.valid_ice_cells * 1.0 / c.ice_cells >= 0.01"""),
    # Large stack: one row per field and cell observation.
    "li": ((), """
        SELECT l_orderkey AS field_id, CAST(l_suppkey % 10 AS INTEGER) AS iy, CAST(l_partkey % 20 AS INTEGER) AS ix,
               round(l_discount * 10 - 0.5, 6) AS dx, round(l_tax * 10 - 0.4, 6) AS dy,
               CAST(l_shipdate AS DATE) AS shipdate, l_shipdate AS ship_ts,
               lpad(CAST(l_orderkey % 25 AS VARCHAR), 3, '0') || '_NATION_' || (l_orderkey % 25) AS region
        FROM lineitem"""),
    # Fields of the delivered cube, one row per order.
    "cube": ((), """
        SELECT o_orderkey AS field_id,
               lpad(CAST(o_custkey % 25 AS VARCHAR), 3, '0') || '_NATION_' || (o_custkey % 25) AS region,
               o_orderdate AS scene_1_datetime,
               o_orderdate + to_hours(CAST(12 + o_custkey % 480 AS BIGINT)) AS scene_2_datetime,
               CASE WHEN o_orderstatus = 'F' THEN 'S2' ELSE 'L8' END AS sensor, o_totalprice AS score
        FROM orders"""),
    "cube_t": (("cube",), """
        SELECT *, make_timestamp((epoch_us(scene_1_datetime) + epoch_us(scene_2_datetime)) // 2) AS midpoint_datetime,
               strftime(scene_1_datetime, '%Y%m%dT%H%M%S') AS d1, strftime(scene_2_datetime, '%Y%m%dT%H%M%S') AS d2
        FROM cube"""),
    "cube_id": (("cube_t",), """
        SELECT *, region || '_' || d1 || '_' || d2 || '_' || sensor || '_' || field_id AS id FROM cube_t"""),
    # A delivery and the baseline it is compared with.
    "base": (("px",), "SELECT region, field_id, component, iy, ix, value FROM px"),
    "cand": (("px",), """
        SELECT p.region, p.field_id, p.component, p.iy, p.ix,
               CASE WHEN s.m > 4.0 THEN p.value + 1 ELSE p.value END AS value
        FROM px p JOIN (SELECT field_id, max(value) AS m, min(value) AS n FROM px GROUP BY ALL) s USING (field_id)
        WHERE s.n > -4.4"""),
}


def _needed(names, seen):
    for name in names:
        if name not in seen:
            _needed(VIEWS[name][0], seen)
            seen.append(name)
    return seen


def with_views(sql, names):
    views = _needed(names, [])
    if not views:
        return sql
    body = ",\n".join(f"{v} AS ({VIEWS[v][1]})" for v in views)
    rest = sql.strip()
    return f"WITH {body},\n{rest[4:]}" if rest.startswith("WITH") else f"WITH {body}\n{rest}"
