"""The registered queries in SQL for another engine, over the same tables."""


def _d(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


_RAW = f"""
fx_u AS (SELECT max(user_id) + 1 AS u FROM events),
fx_all AS (
  SELECT user_id AS scene_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS view_idx,
    count(*) OVER (PARTITION BY user_id) AS n FROM events),
fx_p AS (
  SELECT scene_id, view_idx, event_id, n, ((event_id*31)%211)/{_d(10)} - {_d(10.5)} AS pos_x, ((event_id*47)%223)/{_d(10)} - {_d(11.1)} AS pos_y,
    {_d(1.2)} + ((event_id*13)%9)/{_d(10)} AS pos_z, radians(CAST((event_id*37)%360 AS DOUBLE)) AS y, radians(CAST((event_id*11)%41 - 20 AS DOUBLE)) AS p
  FROM fx_all),
fx_views AS (
  SELECT scene_id, view_idx, event_id, n, pos_x, pos_y, pos_z, sin(y) AS right_x, -cos(y) AS right_y, {_d(0)} AS right_z,
    sin(p)*cos(y) AS down_x, sin(p)*sin(y) AS down_y, -cos(p) AS down_z, cos(p)*cos(y) AS fwd_x, cos(p)*sin(y) AS fwd_y, sin(p) AS fwd_z FROM fx_p),
fx_objects AS (
  SELECT p_partkey % u AS scene_id, p_partkey AS node_id, split_part(p_name, ' ', 2) AS tag,
    ((p_partkey*37)%199)/{_d(10)} - {_d(9.9)} AS c_x, ((p_partkey*53)%197)/{_d(10)} - {_d(9.8)} AS c_y, ((p_partkey*29)%31)/{_d(10)} AS c_z,
    {_d(0.2)} + (p_size%10)/{_d(10)} AS l_x, {_d(0.2)} + ((p_partkey*7)%11)/{_d(10)} AS l_y, {_d(0.2)} + (p_size%7)/{_d(5)} AS l_z,
    radians(CAST((p_partkey*41)%360 - 180 AS DOUBLE)) AS e0, radians(CAST((p_partkey*17)%61 - 30 AS DOUBLE)) AS e1, radians(CAST((p_partkey*23)%360 - 180 AS DOUBLE)) AS e2
  FROM part, fx_u),
fx_seen AS (SELECT v.scene_id, v.view_idx, o.node_id FROM fx_views v JOIN fx_objects o USING (scene_id) WHERE (v.event_id*7 + o.node_id*13) % 4 = 0),
fx_pixels AS (SELECT l_suppkey AS frame_id, l_linenumber AS obj_idx, l_partkey % 64 AS u, l_suppkey % 48 AS v, l_quantity/{_d(10)} AS d FROM lineitem),
fx_cloud AS (SELECT *, (u - 32)*d/{_d(50)} AS p_x, (v - 24)*d/{_d(50)} AS p_y, d AS p_z FROM fx_pixels)"""

_AXES = "pos_x pos_y pos_z right_x right_y right_z down_x down_y down_z fwd_x fwd_y fwd_z".split()


def _pairs(test: str) -> str:
    cols = ", ".join(f"{s}.{c} AS {s}_{c}" for s in "ab" for c in ["view_idx", *_AXES])
    return f"pairs AS (SELECT a.scene_id, {cols} FROM fx_views a JOIN fx_views b ON a.scene_id = b.scene_id AND {test})"


def _norm(*parts: str) -> str:
    return "sqrt(" + " + ".join(f"({p})*({p})" for p in parts) + ")"


def _clip(x: str) -> str:
    return f"greatest({_d(-1)}, least({_d(1)}, {x}))"


def _pmod(x: str, m: float) -> str:
    return f"((({x}) % {_d(m)}) + {_d(m)}) % {_d(m)}"


def _case(names: list[str], angle: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"[{listed}][1 + least(7, CAST(floor(({_pmod(f'{angle} + {_d(22.5)}', 360)}) / {_d(45)}) AS INTEGER))]"


_DELTA = [f"(b_pos_{c} - a_pos_{c})" for c in "xyz"]
_TRACE = " + ".join(f"a_{n}_{c}*b_{n}_{c}" for n in ("right", "down", "fwd") for c in "xyz")
_ANGLE = f"degrees(acos({_clip(f'({_TRACE} - 1)/{_d(2)}')}))"
_DIVERSE = f"({_ANGLE} >= 15 OR {_norm(*_DELTA)} >= {_d(0.5)})"
_GATES = f"{_norm(*_DELTA[:2])} >= {_d(0.3)} AND abs({_DELTA[2]}) <= {_d(0.3)} AND {_DIVERSE}"
_OCTANTS = ["Front", "Front-Right", "Right", "Back-Right", "Back", "Back-Left", "Left", "Front-Left"]
_FACINGS = ["right", "down-right", "down", "down-left", "left", "up-left", "up", "up-right"]


def _ground(c: str, x: str, y: str) -> tuple[str, str]:
    """dx, dz of a ground point from camera columns with a prefix (cameras here are never upright)."""
    ox, oy = f"({x} - {c}pos_x)", f"({y} - {c}pos_y)"
    rn, fn = _norm(f"{c}right_x", f"{c}right_y"), _norm(f"{c}fwd_x", f"{c}fwd_y")
    return f"({ox}*{c}right_x + {oy}*{c}right_y)/{rn}", f"({ox}*{c}fwd_x + {oy}*{c}fwd_y)/{fn}"


def _clear(dx: str = "dx", dz: str = "dz", margin: float = 5) -> str:
    off = _pmod(f"degrees(atan2({dx}, {dz})) + {_d(22.5)}", 45)
    return f"NOT (abs({dx}) < {_d(0.05)} AND abs({dz}) < {_d(0.05)}) AND abs({off} - {_d(22.5)}) <= {_d(22.5 - margin)}"


def _r(x: str, n: int = 6) -> str:
    return f"round({x}, {n}) + 0"


def _dot(a: list[str], b: list[str]) -> str:
    return "(" + " + ".join(f"{x}*{y}" for x, y in zip(a, b)) + ")"


_OCT = _case(_OCTANTS, "degrees(atan2(dx, dz))")
_AB = _ground("a_", "b_pos_x", "b_pos_y")


def _camera_object(variant: str) -> str:
    dx, dz = _ground("a.", "o.c_x", "o.c_y")
    keep = f"abs(degrees(atan2(dx, dz))) >= {_d(30)} AND" if variant == "self" else ""
    seen = "EXISTS" if variant == "self" else "NOT EXISTS"
    other = "" if variant == "self" else "JOIN fx_seen s ON s.scene_id = p.scene_id AND s.view_idx = p.b_view_idx AND s.node_id = t.node_id"
    return f"""WITH {_RAW}, {_pairs("a.view_idx <> b.view_idx")},
t AS (SELECT a.scene_id, a.view_idx, o.node_id, {dx} AS dx, {dz} AS dz FROM fx_views a JOIN fx_objects o USING (scene_id) WHERE o.tag NOT IN ('floor', 'ceiling', 'wall')),
u AS (SELECT * FROM t WHERE {keep} {_norm('dx', 'dz')} >= {_d(0.3)} AND {_clear()}
  AND {seen} (SELECT 1 FROM fx_seen s WHERE s.scene_id = t.scene_id AND s.view_idx = t.view_idx AND s.node_id = t.node_id))
SELECT p.scene_id, t.node_id, p.a_view_idx, p.b_view_idx, {_r('dx')} AS dx, {_r('dz')} AS dz, {_OCT} AS answer
FROM pairs p JOIN u t ON t.scene_id = p.scene_id AND t.view_idx = p.a_view_idx {other} WHERE {_GATES}"""


_REP = "rep AS (SELECT scene_id, tag, min(node_id) AS node_id, arg_min(c_x, node_id) AS c_x, arg_min(c_y, node_id) AS c_y, arg_min(c_z, node_id) AS c_z FROM fx_objects WHERE tag NOT IN ('floor', 'ceiling', 'wall') GROUP BY scene_id, tag)"
_AROUND = f"""{_pairs("a.view_idx < b.view_idx")},
co AS (SELECT p.*, o.node_id, a_pos_x - o.c_x AS ax, a_pos_y - o.c_y AS ay, b_pos_x - o.c_x AS bx, b_pos_y - o.c_y AS by_
  FROM pairs p JOIN fx_seen s ON s.scene_id = p.scene_id AND s.view_idx = a_view_idx JOIN fx_seen r ON r.scene_id = p.scene_id AND r.view_idx = b_view_idx AND r.node_id = s.node_id
  JOIN fx_objects o ON o.scene_id = p.scene_id AND o.node_id = s.node_id),
ar AS (SELECT *, {_norm('ax', 'ay')} >= {_d(1e-3)} AND {_norm('bx', 'by_')} >= {_d(1e-3)} AS far, ax*by_ - ay*bx AS crossed,
  degrees(acos({_clip(f"(ax*bx + ay*by_)/nullif({_norm('ax', 'ay')}*{_norm('bx', 'by_')}, 0)")})) AS angle FROM co)"""
_TRIG = "b AS (SELECT *, sin(e0) AS s0, sin(e1) AS s1, sin(e2) AS s2, cos(e0) AS c0, cos(e1) AS c1, cos(e2) AS c2 FROM fx_objects)"
_BOX = [["(c2*c0 + s2*s1*s0)", "(c1*s0)", "(-s2*c0 + c2*s1*s0)"], ["(-c2*s0 + s2*s1*c0)", "(c1*c0)", "(s2*s0 + c2*s1*c0)"], ["(s2*c1)", "(-s1)", "(c2*c1)"]]
_TOP = "greatest(" + ", ".join(f"c_z + {i}*l_x/2*{_BOX[0][2]} + {j}*l_y/2*{_BOX[1][2]} + {k}*l_z/2*{_BOX[2][2]}" for i in (-1, 1) for j in (-1, 1) for k in (-1, 1)) + ")"
_CAM = {n: [f"v.{n}_{c}" for c in "xyz"] for n in ("right", "down", "fwd")}


def _metric(x: str) -> str:
    return f"CASE WHEN {x} < 1 THEN printf('%.2f centimeters', round({x}*100, 2)) ELSE printf('%.2f meters', round({x}, 2)) END"


def _folded(x: str) -> str:
    return f"CASE WHEN round({x}, 4) <= {_d(-3.1416)} THEN {_d(3.1416)} ELSE round({x}, 4) + 0 END"


def _share(source: str, value: str, share: float, name: str) -> str:
    return f"""WITH {_RAW}, h AS (SELECT frame_id, obj_idx, {value} AS x FROM {source}),
k AS (SELECT *, row_number() OVER (PARTITION BY frame_id, obj_idx ORDER BY x) AS rn, count(*) OVER (PARTITION BY frame_id, obj_idx) AS n FROM h)
SELECT frame_id, obj_idx, max(n) AS n, greatest(1, floor({_d(share)}*max(n)))::BIGINT AS k, {_r('avg(x)')} AS {name} FROM k
WHERE rn <= greatest(1, floor({_d(share)}*n)) GROUP BY frame_id, obj_idx"""


_FRONT = _share("fx_pixels WHERE d > 0", "d", 0.1, "depth")
_CLOSE = _share("fx_cloud", _norm("p_x", "p_y", "p_z"), 0.2, "distance")
_ORDER = f"SELECT frame_id, obj_idx, depth, CAST(row_number() OVER (PARTITION BY frame_id ORDER BY depth, obj_idx) AS INTEGER) AS rank FROM ({_FRONT})"
_PTS = "pts AS (SELECT DISTINCT frame_id, obj_idx, round(p_x, 6) AS x, round(p_y, 6) AS y, round(p_z, 6) AS z FROM fx_cloud)"
_NN = f"""nn AS (SELECT a.frame_id, a.obj_idx AS a_obj, b.obj_idx AS b_obj, min({_norm('a.x - b.x', 'a.y - b.y', 'a.z - b.z')}) AS distance
  FROM pts a JOIN pts b ON a.frame_id = b.frame_id AND b.obj_idx > a.obj_idx GROUP BY ALL)"""


def _bev(x: str = "x", where: str = "") -> str:
    col = lambda v, c: f"greatest(0, least(9, CAST(trunc(round(({v} - {c}min)/({c}max - {c}min)*10, 9)) AS INTEGER)))"
    ents = """ent AS (SELECT scene_id, 'camera' AS kind, view_idx AS entity_id, pos_x AS x, pos_y AS y, CAST(0 AS DOUBLE) AS hx, CAST(0 AS DOUBLE) AS hy, degrees(atan2(fwd_y, fwd_x)) AS yaw FROM fx_views
  UNION ALL SELECT scene_id, 'object', node_id, c_x, c_y, l_x/2, l_y/2, degrees(e2) FROM fx_objects)"""
    return f"""WITH {_RAW}, {ents},
b0 AS (SELECT scene_id, min(x - hx) AS x0, max(x + hx) AS x1, min(y - hy) AS y0, max(y + hy) AS y1 FROM ent GROUP BY scene_id),
b1 AS (SELECT scene_id, CASE WHEN x1 - x0 < 1e-6 THEN x0 - {_d(0.5)} ELSE x0 END AS x0, CASE WHEN x1 - x0 < 1e-6 THEN x1 + {_d(0.5)} ELSE x1 END AS x1,
  CASE WHEN y1 - y0 < 1e-6 THEN y0 - {_d(0.5)} ELSE y0 END AS y0, CASE WHEN y1 - y0 < 1e-6 THEN y1 + {_d(0.5)} ELSE y1 END AS y1 FROM b0),
bb AS (SELECT scene_id, x0 - (x1 - x0)*{_d(0.1)} AS xmin, x1 + (x1 - x0)*{_d(0.1)} AS xmax, y0 - (y1 - y0)*{_d(0.1)} AS ymin, y1 + (y1 - y0)*{_d(0.1)} AS ymax FROM b1),
pl AS (SELECT e.*, {col('y', 'y')} AS row, {col(x, 'x')} AS col, {_case(_FACINGS, 'round(yaw, 9)')} AS facing FROM ent e JOIN bb USING (scene_id))"""


ORACLE = {
    "camera_movement": f"""WITH {_RAW}, e AS (SELECT scene_id, min(view_idx) AS a, max(view_idx) AS b FROM fx_views GROUP BY scene_id HAVING count(*) >= 2),
m AS (SELECT e.scene_id, e.a AS start_view, e.b AS end_view,
  {_dot([f'(b.pos_{c} - a.pos_{c})' for c in 'xyz'], [f'a.fwd_{c}' for c in 'xyz'])} AS f, {_dot([f'(b.pos_{c} - a.pos_{c})' for c in 'xyz'], [f'a.right_{c}' for c in 'xyz'])} AS r
  FROM e JOIN fx_views a ON a.scene_id = e.scene_id AND a.view_idx = e.a JOIN fx_views b ON b.scene_id = e.scene_id AND b.view_idx = e.b)
SELECT scene_id, start_view, end_view, {_r('f')} AS forward, {_r('r')} AS rightward,
  CASE WHEN f = greatest(f, -f, r, -r) THEN 'Forward' WHEN -f = greatest(f, -f, r, -r) THEN 'Backward' WHEN r = greatest(f, -f, r, -r) THEN 'Right' ELSE 'Left' END AS answer
FROM m WHERE greatest(f, -f, r, -r) >= {_d(0.2)}""",
    "camera_pair_octant": f"""WITH {_RAW}, {_pairs("a.view_idx < b.view_idx")}, q AS (SELECT scene_id, a_view_idx, b_view_idx, {_AB[0]} AS dx, {_AB[1]} AS dz FROM pairs WHERE {_GATES})
SELECT q.scene_id, a_view_idx, b_view_idx, {_r('dx')} AS dx, {_r('dz')} AS dz, {_OCT} AS answer, s.node_id
FROM q JOIN fx_seen s ON s.scene_id = q.scene_id AND s.view_idx = a_view_idx JOIN fx_seen r ON r.scene_id = q.scene_id AND r.view_idx = b_view_idx AND r.node_id = s.node_id WHERE {_clear()}""",
    "camera_object_self": _camera_object("self"),
    "camera_object_cross": _camera_object("cross"),
    "object_object_lr": f"""WITH {_RAW}, {_pairs("a.view_idx < b.view_idx")},
q AS (SELECT scene_id, a_view_idx, b_view_idx, {_DELTA[0]} AS fx, {_DELTA[1]} AS fy FROM pairs WHERE {_DIVERSE}),
v AS (SELECT DISTINCT q.scene_id, a_view_idx, b_view_idx, node_id FROM q JOIN fx_seen s ON s.scene_id = q.scene_id AND (s.view_idx = a_view_idx OR s.view_idx = b_view_idx)),
w AS (SELECT q.scene_id, q.a_view_idx, q.b_view_idx, m.node_id AS node_a, o.node_id AS node_b, ((m.c_x - o.c_x)*fy - (m.c_y - o.c_y)*fx)/{_norm('fx', 'fy')} AS side
  FROM q JOIN v x USING (scene_id, a_view_idx, b_view_idx) JOIN v y USING (scene_id, a_view_idx, b_view_idx)
  JOIN fx_objects m ON m.node_id = x.node_id JOIN fx_objects o ON o.node_id = y.node_id WHERE m.node_id < o.node_id AND m.tag <> o.tag AND {_norm('fx', 'fy')} >= {_d(1e-3)})
SELECT scene_id, node_a, node_b, CASE WHEN abs(round(side, 9)) < {_d(0.3)} THEN 'Same line' WHEN side > 0 THEN 'Right' ELSE 'Left' END AS answer, count(*) AS n, min(a_view_idx) AS first_view, {_r('max(round(side, 6))')} AS most FROM w GROUP BY ALL""",
    "camera_motion": f"""WITH {_RAW}, {_pairs("a.view_idx < b.view_idx")},
n AS (SELECT * FROM pairs),
m AS (SELECT scene_id, a_view_idx, b_view_idx, {_dot(_DELTA, [f'a_right_{c}' for c in 'xyz'])} AS x, {_dot(_DELTA, [f'a_down_{c}' for c in 'xyz'])} AS y, {_dot(_DELTA, [f'a_fwd_{c}' for c in 'xyz'])} AS z, {_ANGLE} AS angle FROM n)
SELECT scene_id, a_view_idx, b_view_idx, {_r('x', 5)} AS x, {_r('z', 5)} AS z, {_r(_norm('x', 'y', 'z'), 5)} AS distance, {_r('angle', 5)} AS angle,
  CASE WHEN {_norm('x', 'y', 'z')} < {_d(0.1)} THEN CASE WHEN angle < 10 THEN 'Static' ELSE 'Pure rotation' END
    WHEN abs(z) >= abs(x) THEN CASE WHEN z > 0 THEN 'Forward' ELSE 'Backward' END || ' + ' || CASE WHEN x < 0 THEN 'left' ELSE 'right' END
    ELSE CASE WHEN x > 0 THEN 'Right' ELSE 'Left' END || ' + ' || CASE WHEN z > 0 THEN 'forward' ELSE 'backward' END END AS answer FROM m""",
    "clockwise": f"WITH {_RAW}, {_AROUND} SELECT scene_id, node_id, a_view_idx, b_view_idx, {_r('angle', 5)} AS angle, crossed < 0 AS clockwise FROM ar WHERE far AND round(angle, 9) >= 20",
    "view_change": f"""WITH {_RAW}, {_AROUND}, c AS (SELECT *, CASE WHEN far THEN angle ELSE 0 END AS yaw, {_dot(_DELTA, [f'a_right_{c}' for c in 'xyz'])} AS sideways, abs(degrees(asin({_clip('b_fwd_z - a_fwd_z')}))) AS tilt FROM ar)
SELECT scene_id, node_id, a_view_idx, b_view_idx, {_r('yaw', 5)} AS yaw, {_r('sideways', 5)} AS sideways, {_r('tilt', 5)} AS tilt,
  CASE WHEN round(yaw, 9) >= 60 THEN CASE WHEN crossed < 0 THEN 'Rotated clockwise' ELSE 'Rotated counter-clockwise' END
    WHEN abs(round(sideways, 9)) >= {_d(0.3)} THEN CASE WHEN sideways < 0 THEN 'Translated left' ELSE 'Translated right' END WHEN round(tilt, 9) >= 20 THEN 'Tilted' ELSE 'Unchanged' END AS answer FROM c""",
    "relative_distance_centers": f"""WITH {_RAW}, {_REP},
t AS (SELECT a.scene_id, a.node_id AS node_a, b.node_id AS node_b, c.node_id AS node_c, {_norm(*[f'a.c_{k} - b.c_{k}' for k in 'xyz'])} AS dist_b, {_norm(*[f'a.c_{k} - c.c_{k}' for k in 'xyz'])} AS dist_c
  FROM rep a JOIN rep b ON a.scene_id = b.scene_id AND a.tag <> b.tag JOIN rep c ON a.scene_id = c.scene_id AND b.tag < c.tag AND a.tag <> c.tag)
SELECT scene_id, node_a, node_b, node_c, {_r('dist_b')} AS dist_b, {_r('dist_c')} AS dist_c, CASE WHEN abs(round(dist_b - dist_c, 9)) < {_d(0.3)} THEN 'equal' WHEN dist_b < dist_c THEN 'B' ELSE 'C' END AS answer FROM t""",
    "duplicate_tag_count": f"WITH {_RAW} SELECT scene_id, tag, count(*) AS n FROM fx_objects GROUP BY scene_id, tag HAVING count(*) > 1",
    "relative_size": f"""WITH {_RAW}, v AS (SELECT scene_id, node_id, tag, round(abs(l_x*l_y*l_z), 9) AS v FROM fx_objects)
SELECT a.scene_id, a.node_id AS node_a, b.node_id AS node_b, a.v > b.v AS bigger, a.v < b.v AS smaller FROM v a JOIN v b ON a.scene_id = b.scene_id AND a.node_id < b.node_id AND a.tag <> b.tag""",
    "extreme_sizes": f"""WITH {_RAW}, v AS (SELECT scene_id, node_id, round(abs(l_x*l_y*l_z), 9) AS v FROM fx_objects),
r AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY v DESC, node_id) AS most, row_number() OVER (PARTITION BY scene_id ORDER BY v, node_id) AS least FROM v)
SELECT scene_id, max(CASE WHEN most = 1 THEN node_id END) AS biggest, max(CASE WHEN least = 1 THEN node_id END) AS smallest FROM r GROUP BY scene_id""",
    "absolute_size": f"""WITH {_RAW} SELECT scene_id, node_id, {_r('greatest(l_x, l_y, l_z)')} AS extent, {_r('l_z')} AS height, {_r('abs(l_x*l_y*l_z)')} AS volume,
  {_metric('greatest(l_x, l_y, l_z)')} AS extent_text, {_metric('l_z')} AS height_text FROM fx_objects""",
    "height_compare": f"""WITH {_RAW}, {_TRIG}, t AS (SELECT scene_id, node_id, tag, round({_TOP}, 6) AS top FROM b)
SELECT a.scene_id, a.node_id AS node_a, b.node_id AS node_b, a.top + 0 AS a_top, b.top + 0 AS b_top, CASE WHEN a.top > b.top THEN 'A' ELSE 'B' END AS answer FROM t a JOIN t b ON a.scene_id = b.scene_id AND a.node_id < b.node_id AND a.tag <> b.tag""",
    "box_world_to_camera": f"""WITH {_RAW}, {_TRIG} SELECT v.scene_id, v.view_idx, b.node_id,
  {', '.join(f"{_r(_dot([f'(b.c_{c} - v.pos_{c})' for c in 'xyz'], _CAM[n]), 4)} AS x_{k}" for k, n in zip('xyz', _CAM))},
  {_folded(f"atan2({_dot(_BOX[0], _CAM['down'])}, {_dot(_BOX[1], _CAM['down'])})")} AS e0,
  {_folded(f"asin({_clip('-' + _dot(_BOX[2], _CAM['down']))})")} AS e1,
  {_folded(f"atan2({_dot(_BOX[2], _CAM['right'])}, {_dot(_BOX[2], _CAM['fwd'])})")} AS e2
FROM fx_seen s JOIN fx_views v ON v.scene_id = s.scene_id AND v.view_idx = s.view_idx JOIN b ON b.scene_id = s.scene_id AND b.node_id = s.node_id""",
    "compass_relation": f"""WITH {_RAW}, {_REP},
t AS (SELECT a.scene_id, a.node_id AS node_a, b.node_id AS node_b, c.node_id AS node_c, c.c_x - b.c_x AS x, c.c_y - b.c_y AS y, radians(degrees(atan2(a.c_x - b.c_x, a.c_y - b.c_y))) AS r
  FROM rep a JOIN rep b ON a.scene_id = b.scene_id AND a.tag < b.tag JOIN rep c ON c.scene_id = a.scene_id AND c.tag <> a.tag AND c.tag <> b.tag),
q AS (SELECT scene_id, node_a, node_b, node_c, round(x*cos(r) - y*sin(r), 9) AS dx, round(x*sin(r) + y*cos(r), 9) AS dy FROM t),
g AS (SELECT *, degrees(atan2(dx, dy)) AS a FROM q)
SELECT scene_id, node_a, node_b, node_c, {_r('dx')} AS dx, {_r('dy')} AS dy, CASE WHEN a > -15 AND a <= 15 THEN 'north' WHEN a > 15 AND a <= 75 THEN 'northeast' WHEN a > 75 AND a <= 105 THEN 'east'
  WHEN a > 105 AND a <= 165 THEN 'southeast' WHEN a > 165 OR a <= -165 THEN 'south' WHEN a > -165 AND a <= -105 THEN 'southwest' WHEN a > -105 AND a <= -75 THEN 'west' ELSE 'northwest' END AS answer FROM g""",
    "fov": f"WITH {_RAW} SELECT frame_id, max(u) + 1 AS width, {_r(f'degrees(2*atan2(CAST(max(u) + 1 AS DOUBLE), 2*{_d(50)}))')} AS fov FROM fx_pixels GROUP BY frame_id",
    "project_objects": f"""WITH {_RAW}, c AS (SELECT s.scene_id, s.view_idx, s.node_id, {', '.join(f"{_dot([f'(o.c_{k} - v.pos_{k})' for k in 'xyz'], _CAM[n])} AS p{i}" for i, n in enumerate(_CAM))}
  FROM fx_seen s JOIN fx_views v ON v.scene_id = s.scene_id AND v.view_idx = s.view_idx JOIN fx_objects o ON o.node_id = s.node_id)
SELECT scene_id, view_idx, node_id, {_r('50*p0/p2 + 32', 4)} AS px, {_r('50*p1/p2 + 24', 4)} AS py, {_r('p2', 4)} AS p_z FROM c WHERE p2 > {_d(0.01)}""",
    "flatten": """SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_quantity) - 1 AS INTEGER) AS pos, l_partkey AS parts, l_quantity AS quantities,
  CAST(count(*) OVER (PARTITION BY l_orderkey) AS INTEGER) AS n FROM lineitem""",
    "group": f"""WITH {_RAW} SELECT CAST(scene_id AS VARCHAR) AS scene_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY view_idx) AS events,
  string_agg(CASE WHEN event_id % 3 <> 0 THEN CAST(event_id AS VARCHAR) ELSE 'null' END, ',' ORDER BY view_idx) AS depths FROM fx_all GROUP BY scene_id""",
    "merge_scenes": f"""WITH {_RAW} SELECT scene_id, 'ds' || CAST(scene_id % 3 AS VARCHAR) AS dataset, CAST(count(*) AS INTEGER) AS num_images, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY view_idx) AS events FROM fx_views GROUP BY scene_id""",
    "flatten_qa": """SELECT CAST(conv_id AS VARCHAR) AS image, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS INTEGER) AS qa_idx, text AS messages, CASE WHEN turn % 2 = 0 THEN 'MCQ' ELSE 'open' END AS question_types
FROM conversations WHERE text IS NOT NULL""",
    "tag_blacklist": f"""WITH {_RAW}, bad AS (SELECT DISTINCT tag FROM fx_objects ORDER BY tag LIMIT 3)
SELECT scene_id, string_agg(tag, ',' ORDER BY node_id) AS tags, string_agg(CAST(node_id AS VARCHAR), ',' ORDER BY node_id) AS ids FROM fx_objects WHERE tag NOT IN (SELECT tag FROM bad) GROUP BY scene_id""",
    "tag_histogram_topk": f"WITH {_RAW} SELECT tag, count(*) AS n FROM fx_objects GROUP BY tag ORDER BY n DESC, tag LIMIT 5",
    "funnel": f"""WITH {_RAW}, many AS (SELECT scene_id, node_id FROM fx_seen GROUP BY ALL HAVING count(DISTINCT view_idx) >= 5),
c AS (SELECT scene_id % 4 AS part, 0 AS stage_no, 'objects' AS stage, count(*) AS n_rows FROM fx_objects GROUP BY ALL
  UNION ALL SELECT scene_id % 4, 1, 'seen', count(*) FROM (SELECT DISTINCT scene_id, node_id FROM fx_seen) GROUP BY ALL
  UNION ALL SELECT scene_id % 4, 2, 'connected', count(*) FROM many GROUP BY ALL UNION ALL SELECT scene_id % 4, 3, 'few', count(*) FROM many WHERE node_id % 61 = 0 GROUP BY ALL),
l AS (SELECT *, coalesce(lag(n_rows) OVER (PARTITION BY part ORDER BY stage_no), n_rows) AS prev_rows FROM c), s AS (SELECT *, round(CASE WHEN prev_rows > 0 THEN n_rows/CAST(prev_rows AS DOUBLE) ELSE 0 END, 6) AS survival FROM l)
SELECT part, stage_no, stage, n_rows, prev_rows, survival, CASE WHEN survival < {_d(0.005)} THEN 'strong' WHEN survival < {_d(0.02)} THEN 'warn' ELSE 'ok' END AS level FROM s""",
    "leak_check": """WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part UNION ALL SELECT lower(p_type) FROM part), bad AS (SELECT DISTINCT lower(p_type) AS tag FROM part ORDER BY tag LIMIT 2)
SELECT lower(tag) AS tag, count(*) AS n FROM w WHERE lower(tag) IN (SELECT tag FROM bad) GROUP BY lower(tag)""",
    "view_subsample": f"WITH {_RAW}, i AS (SELECT unnest(range(10)) AS i) SELECT scene_id, view_idx FROM fx_all WHERE n <= 10 OR view_idx IN (SELECT (i*n)//10 FROM i)",
    "well_connected_nodes": f"WITH {_RAW} SELECT scene_id, node_id, count(DISTINCT view_idx) AS n_views FROM fx_seen GROUP BY ALL HAVING count(DISTINCT view_idx) >= 3",
    "covisible_pairs": f"WITH {_RAW} SELECT a.scene_id, a.view_idx AS a_view_idx, b.view_idx AS b_view_idx, count(*) AS shared FROM fx_seen a JOIN fx_seen b ON a.scene_id = b.scene_id AND a.node_id = b.node_id AND a.view_idx < b.view_idx GROUP BY ALL",
    "only_in_view": f"""WITH {_RAW}, t AS (SELECT DISTINCT s.scene_id, s.view_idx, o.tag FROM fx_seen s JOIN fx_objects o ON o.node_id = s.node_id)
SELECT a.scene_id, a.view_idx AS a_view_idx, b.view_idx AS b_view_idx, t.tag FROM fx_views a JOIN fx_views b ON a.scene_id = b.scene_id AND a.view_idx < b.view_idx
JOIN t ON t.scene_id = a.scene_id AND t.view_idx = a.view_idx WHERE NOT EXISTS (SELECT 1 FROM t x WHERE x.scene_id = b.scene_id AND x.view_idx = b.view_idx AND x.tag = t.tag)""",
    "merge_boxes": """WITH k AS (SELECT p_partkey % 97 AS frame_id, p_partkey AS obj_idx, lower(p_type) AS tag, (p_partkey*7)%20 AS x1, (p_partkey*11)%20 AS y1, p_size, p_partkey FROM part),
b AS (SELECT frame_id, obj_idx, tag, x1, y1, CAST(x1 + 5 + p_size%10 AS BIGINT) AS x2, y1 + 5 + (p_partkey*3)%10 AS y2 FROM k), a AS (SELECT *, CAST((x2 - x1)*(y2 - y1) AS DOUBLE) AS area FROM b),
lost AS (SELECT i.frame_id, CASE WHEN i.area < j.area THEN i.obj_idx ELSE j.obj_idx END AS obj_idx FROM a i JOIN a j ON i.frame_id = j.frame_id AND i.tag = j.tag AND i.obj_idx < j.obj_idx
  WHERE least(i.x2, j.x2) > greatest(i.x1, j.x1) AND least(i.y2, j.y2) > greatest(i.y1, j.y1)
    AND (least(i.x2, j.x2) - greatest(i.x1, j.x1))*(least(i.y2, j.y2) - greatest(i.y1, j.y1))/least(i.area, j.area) > CAST(0.8 AS DOUBLE))
SELECT frame_id, obj_idx, tag, x1, y1, x2, y2 FROM b WHERE (frame_id, obj_idx) NOT IN (SELECT (frame_id, obj_idx) FROM lost)""",
    "front_surface_depth": _FRONT,
    "depth_order": _ORDER,
    "nth_closest": f"SELECT frame_id, obj_idx, depth FROM ({_ORDER}) WHERE rank = 2",
    "closest20_mean": _CLOSE,
    "distance_obj_cam": f"""WITH m AS ({_CLOSE}) SELECT obj_idx, a.frame_id AS a_frame_id, a.distance AS a_distance, b.frame_id AS b_frame_id, b.distance AS b_distance,
  CASE WHEN abs(round(a.distance - b.distance, 9)) < {_d(0.08)} THEN 'equal' WHEN a.distance < b.distance THEN 'View 1' ELSE 'View 2' END AS answer FROM m a JOIN m b USING (obj_idx) WHERE b.frame_id > a.frame_id""",
    "backproject": f"WITH {_RAW} SELECT frame_id, obj_idx, count(*) AS n, {', '.join(f'{_r(f"sum(p_{k})", 4)} AS sum_{k}' for k in 'xyz')} FROM fx_cloud GROUP BY frame_id, obj_idx",
    "cloud_extent": f"WITH {_RAW} SELECT frame_id, obj_idx, {', '.join(f'{_r(f"max(p_{k}) - min(p_{k})")} AS size_{k}' for k in 'xyz')} FROM fx_cloud GROUP BY frame_id, obj_idx",
    "mask_box": f"WITH {_RAW} SELECT frame_id, obj_idx, min(u) AS x1, min(v) AS y1, max(u) AS x2, max(v) AS y2 FROM fx_pixels GROUP BY frame_id, obj_idx",
    "obb_contains": f"""WITH {_RAW}, {_TRIG} SELECT b.scene_id, b.node_id, count(*) AS n_points,
  CAST(sum(CASE WHEN {' AND '.join(f"abs({_dot([f'(p.c_{k} - b.c_{k})' for k in 'xyz'], axis)}) <= b.l_{c}*4/2" for c, axis in zip('xyz', _BOX))} THEN 1 ELSE 0 END) AS BIGINT) AS n_inside
FROM b JOIN fx_objects p ON p.scene_id = b.scene_id GROUP BY b.scene_id, b.node_id""",
    "nn_distance": f"WITH {_RAW}, {_PTS}, {_NN} SELECT frame_id, a_obj, b_obj, {_r('distance')} AS distance FROM nn",
    "proximity": f"""WITH {_RAW}, {_PTS}, {_NN}, e AS (SELECT frame_id, obj_idx, ((max(x) - min(x)) + (max(y) - min(y)) + (max(z) - min(z)))/3 AS e FROM pts GROUP BY ALL),
p AS (SELECT nn.frame_id, a_obj, b_obj, distance, (x.e + y.e)/2 AS extent FROM nn JOIN e x ON x.frame_id = nn.frame_id AND x.obj_idx = a_obj JOIN e y ON y.frame_id = nn.frame_id AND y.obj_idx = b_obj),
r AS (SELECT *, coalesce(round(distance/CASE WHEN extent > 0 THEN extent END, 9), CAST('inf' AS DOUBLE)) AS ratio FROM p)
SELECT frame_id, a_obj, b_obj, {_r('distance')} AS distance, {_r('extent')} AS extent, {_r('ratio')} AS ratio, CASE WHEN ratio < {_d(0.05)} THEN 'next' ELSE 'far' END AS answer FROM r WHERE ratio < {_d(0.05)} OR ratio > {_d(0.1)}""",
    "voxel_range_join": f"""WITH {_RAW}, {_PTS}, q AS (SELECT DISTINCT frame_id, x, y, z FROM pts)
SELECT a.frame_id AS a_frame_id, b.frame_id AS b_frame_id, count(*) AS n FROM q a JOIN q b ON b.frame_id > a.frame_id AND abs(a.x - b.x) <= {_d(0.051)} AND round({_norm('a.x - b.x', 'a.y - b.y', 'a.z - b.z')}, 9) <= {_d(0.05)} GROUP BY a.frame_id, b.frame_id""",
    "bev_cells": f"{_bev()} SELECT scene_id, row, col, count(*) AS n FROM pl GROUP BY scene_id, row, col",
    "facing_words": f"{_bev()} SELECT scene_id, entity_id, row, col, facing FROM pl WHERE kind = 'camera'",
    "bev_perturbed": f"""{_bev()}, mm AS (SELECT pl.*, xmin, xmax, ymin, ymax, kind = 'camera' AS cam FROM pl JOIN bb USING (scene_id)), ops AS (SELECT unnest(['mirror_x', 'mirror_y', 'rotate_180']) AS op),
q AS (SELECT op, mm.scene_id, kind, entity_id, xmin, xmax, ymin, ymax, CASE WHEN cam AND op <> 'mirror_y' THEN xmin + xmax - x ELSE x END AS x, CASE WHEN cam AND op <> 'mirror_x' THEN ymin + ymax - y ELSE y END AS y FROM mm, ops)
SELECT op, scene_id, kind, entity_id, greatest(0, least(9, CAST(trunc(round((y - ymin)/(ymax - ymin)*10, 9)) AS INTEGER))) AS row, greatest(0, least(9, CAST(trunc(round((x - xmin)/(xmax - xmin)*10, 9)) AS INTEGER))) AS col, round(x, 4) + 0 AS x, round(y, 4) + 0 AS y FROM q""",
    "pose_validation": f"""WITH {_RAW}, t AS (SELECT scene_id, view_idx, round(right_x*(down_y*fwd_z - fwd_y*down_z) - down_x*(right_y*fwd_z - fwd_y*right_z) + fwd_x*(right_y*down_z - down_y*right_z), 6) AS det FROM fx_views)
SELECT scene_id, view_idx, det + 0 AS det, det BETWEEN {_d(0.9)} AND {_d(1.1)} AS valid FROM t""",
    "resume_anti": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "intersect_scenes": "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels",
    "failure_log": "SELECT event_type AS status, event_id AS id, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE rn <= 10",
    "messages": """SELECT conv_id, turn, repeat('<image>', CAST(turn % 3 AS INTEGER)) || trim(text, ' ') AS human, trim(role || ' Answer: x', ' ') AS gpt
FROM conversations WHERE text IS NOT NULL AND turn % 2 = 0""",
    "blink_output_type": """WITH q AS (SELECT conv_id, turn, '<image>  ' || text || CASE conv_id % 3 WHEN 0 THEN ' A. yes' WHEN 1 THEN ' (B)' ELSE ' A:3' END AS q FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, turn, CASE WHEN regexp_matches(q, '\\b[A-D]\\.\\s|\\([A-D]\\)') THEN 'MCQ' ELSE 'open' END AS output_type, CASE WHEN turn % 2 = 0 THEN 'multiview' ELSE 'singleview' END AS input_type,
  CAST(length(trim(regexp_replace(q, '<image>\\s*', '', 'g'), ' ')) AS INTEGER) AS n FROM q""",
    "path_resolve": """WITH p AS (SELECT page_id, regexp_extract(url, '//[^/]+(/.*)', 1) AS p FROM pages), q AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN p ELSE substring(p, 2) END AS path FROM p),
r AS (SELECT page_id, CASE WHEN starts_with(path, '/') THEN path ELSE '/data/root/' || path END AS f FROM q) SELECT page_id, f AS "full", CASE WHEN starts_with(f, '/data/root/') THEN substring(f, 12) ELSE f END AS short FROM r""",
    "name_cleaning": """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'lamp' ELSE 'chair' END AS name FROM part""",
    "union_tasks": None,
    "page_slice": "SELECT doc_id, source, lang FROM documents ORDER BY source, doc_id LIMIT 10 OFFSET 20",
    "flat_index": """WITH t AS (SELECT DISTINCT conv_id, turn, role FROM conversations WHERE turn IS NOT NULL), n AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn, role) - 1 AS flat_idx FROM t)
SELECT conv_id, turn, role, flat_idx, printf('%08d', flat_idx) AS id FROM n""",
    "scene_validation": """WITH e AS (SELECT count(*) AS frames, count(DISTINCT CASE WHEN user_id % 3 = 0 THEN user_id END) AS less FROM events)
SELECT CAST(frames AS BIGINT) AS claimed, frames, true AS agree, 'whole' AS run FROM e UNION ALL SELECT frames - less, frames, frames - less = frames, 'short' FROM e""",
    "skip_reasons": f"""WITH {_RAW}, {_pairs("a.view_idx < b.view_idx")}, r AS (SELECT CASE WHEN NOT {_DIVERSE} THEN 'pose_not_diverse' WHEN {_norm(*_DELTA[:2])} < {_d(0.3)} THEN 'horizontal_too_close' WHEN abs(round({_DELTA[2]}, 9)) > {_d(0.3)} THEN 'vertical_too_far' ELSE 'ok' END AS reason FROM pairs)
SELECT reason, count(*) AS n FROM r GROUP BY reason""",
    "lookup_labels": "SELECT c_custkey, c_nationkey AS key, coalesce(n_name, 'Unknown') AS label FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0",
    "absolute_distance": f"WITH {_RAW}, {_PTS}, {_NN}, r AS (SELECT frame_id, a_obj, b_obj, round(distance, 6) AS x FROM nn) SELECT frame_id, a_obj, b_obj, {_metric('x')} AS answer FROM r",
    "relative_distance_points": f"""WITH {_RAW}, {_PTS}, {_NN}, r AS (SELECT frame_id, a_obj, b_obj, round(distance, 6) AS x FROM nn)
, t AS (FROM r UNION ALL SELECT frame_id, b_obj, a_obj, x FROM r) SELECT a.frame_id, a.a_obj AS obj, a.b_obj AS a_obj, b.b_obj AS b_obj, a.x AS dist_a, b.x AS dist_b, CASE WHEN a.x > b.x THEN 'A' ELSE 'B' END AS answer FROM t a JOIN t b ON a.frame_id = b.frame_id AND a.a_obj = b.a_obj AND a.b_obj < b.b_obj""",
    "merge_masks": f"""WITH {_RAW}, p AS (SELECT DISTINCT frame_id, obj_idx, obj_idx % 2 AS tag, u % 6 AS u, v FROM fx_pixels), z AS (SELECT frame_id, obj_idx, count(*) AS n FROM p GROUP BY ALL),
c AS (SELECT a.frame_id, a.obj_idx AS i, b.obj_idx AS j, count(*) AS k FROM p a JOIN p b ON a.frame_id = b.frame_id AND a.tag = b.tag AND a.u = b.u AND a.v = b.v AND a.obj_idx < b.obj_idx GROUP BY ALL),
lost AS (SELECT c.frame_id, CASE WHEN x.n < y.n THEN i ELSE j END AS obj_idx FROM c JOIN z x ON x.frame_id = c.frame_id AND x.obj_idx = i JOIN z y ON y.frame_id = c.frame_id AND y.obj_idx = j
  WHERE k/CAST(x.n AS DOUBLE) > {_d(0.8)} OR k/CAST(y.n AS DOUBLE) > {_d(0.8)})
SELECT frame_id, obj_idx FROM z WHERE (frame_id, obj_idx) NOT IN (SELECT (frame_id, obj_idx) FROM lost)""",
    "pixel_labels": f"WITH {_RAW} SELECT frame_id, obj_idx, arg_min(u % 5, v*64 + u) AS label FROM fx_pixels GROUP BY ALL",
    "planar_depths": f"""WITH {_RAW}, p AS (SELECT frame_id, obj_idx, CAST(trunc(d*{_d(50)}/{_norm('u - 32', 'v - 24', _d(50))}*1000) AS INTEGER) AS z FROM fx_pixels) SELECT frame_id, obj_idx, CAST(sum(z) AS BIGINT) AS total, max(z) AS most FROM p GROUP BY ALL""",
    "fused_objects": f"WITH {_RAW} SELECT obj_idx, count(DISTINCT frame_id) AS n_views, count(*) AS n_points FROM fx_pixels GROUP BY obj_idx HAVING count(DISTINCT frame_id) >= 2",
    "tone_mapping": f"""WITH {_RAW}, b AS (SELECT frame_id, d/{_d(5)} AS x FROM fx_pixels), s AS (SELECT frame_id, quantile_cont(x, 0.9) AS p FROM b GROUP BY frame_id),
t AS (SELECT frame_id, CASE WHEN p > 1e-4 THEN pow({_d(0.8)}, 1/({_d(1)}/{_d(2.2)}))/p ELSE 0 END AS scale FROM s)
SELECT frame_id, {_r(f'avg(least(1, pow(greatest(0, scale*x), {_d(1)}/{_d(2.2)})))')} AS mean, {_r('max(scale)')} AS scale FROM b JOIN t USING (frame_id) GROUP BY frame_id""",
}
ORACLE |= {
    "depth_ordering_oe": f"""WITH o AS ({_ORDER}), n AS (SELECT frame_id, round(depth, 6) AS depth, 'object ' || obj_idx AS name FROM o), a AS (SELECT frame_id, string_agg(name, ', ' ORDER BY depth, name) AS answer, CAST(count(*) AS INTEGER) AS n FROM n GROUP BY frame_id HAVING count(*) >= 3)
SELECT frame_id, answer, answer AS gpt, n FROM a""",
    "complete_frames": "SELECT doc_id % 97 AS scene_id, doc_id AS frame_name FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id IN (SELECT page_id FROM pages)",
    "correspondences": f"""WITH {_RAW}, p AS (SELECT DISTINCT frame_id//2 AS pair, frame_id % 2 AS side, u, v, round(p_x, 6) AS x, round(p_y, 6) AS y, round(p_z, 6) AS z FROM fx_cloud WHERE u BETWEEN 4 AND 59 AND v BETWEEN 4 AND 43),
n AS (SELECT a.pair, a.u, a.v, b.u AS u2, b.v AS v2, {_norm('a.x - b.x', 'a.y - b.y', 'a.z - b.z')} AS distance FROM p a JOIN p b ON a.pair = b.pair AND a.side = 0 AND b.side = 1 AND abs(a.x - b.x) < {_d(0.21)}),
m AS (SELECT * FROM n WHERE round(distance, 9) <= {_d(0.2)} QUALIFY row_number() OVER (PARTITION BY pair, u, v ORDER BY distance, u2, v2) = 1)
SELECT pair, u, v, u2, v2, {_r('distance')} AS distance FROM m WHERE pair IN (SELECT pair FROM m GROUP BY pair HAVING count(*) >= 3)""",
    "color_tags": "SELECT p_partkey, split_part(p_name, ' ', 1) AS tag FROM part WHERE p_partkey % 7 <> 0 AND NOT regexp_matches(lower(split_part(p_name, ' ', 1)), 'red|green|blue|yellow|black|white|orange|purple|brown|gray|pink|gold|silver')",
    "task_checks": "SELECT l_orderkey, count(*) > 1 AS counting, count(*) >= 3 AND l_orderkey % 15 <> 0 AND l_orderkey % 3 <> 0 AND l_orderkey % 5 <> 0 AS depth FROM lineitem GROUP BY l_orderkey",
    "tag_priority": """WITH p AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'wall' WHEN 1 THEN lower(p_type) END AS label, CASE WHEN p_partkey % 4 = 0 THEN 'Unknown' ELSE split_part(p_name, ' ', 1) END AS name FROM part)
SELECT p_partkey, CASE WHEN label IS NOT NULL AND label NOT IN ('blinds', 'door', 'otherfurniture', 'otherprop', 'otherstructure', 'wall', 'Unknown') THEN label WHEN name <> 'Unknown' THEN name ELSE 'Unknown' END AS tag FROM p""",
    "first_seen": "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL",
    "smoke_limit": f"WITH {_RAW} SELECT scene_id, view_idx FROM fx_all WHERE scene_id IN (SELECT DISTINCT scene_id FROM fx_all ORDER BY scene_id LIMIT 3) ORDER BY scene_id, view_idx LIMIT 20",
    "missing_paths": """WITH r AS (SELECT doc_id AS id, 'image' AS field, 'image/' || doc_id AS path FROM documents UNION ALL SELECT doc_id, 'depth_map', 'image/' || (doc_id + 1) FROM documents WHERE doc_id % 2 = 0)
SELECT id, field, path FROM r WHERE path NOT IN (SELECT 'image/' || doc_id FROM labels WHERE doc_id IS NOT NULL)""",
    "valid_flags": "SELECT l_orderkey, coalesce(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey, l_quantity) FILTER (WHERE l_quantity > 20), '') AS parts, 1 AS others FROM lineitem GROUP BY l_orderkey",
    "record_problems": """SELECT CAST(c_custkey AS VARCHAR) AS id, 'missing image' AS problem FROM customer WHERE c_custkey % 5 = 0 OR c_name IS NULL UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'depth_scale' FROM customer WHERE c_custkey % 2 <> 0 AND c_custkey % 7 = 0""",
    "nested_histogram": """WITH w AS (SELECT split_part(p_name, ' ', 1) AS tag FROM part UNION ALL SELECT split_part(p_name, ' ', 2) FROM part UNION ALL SELECT split_part(p_name, ' ', 1) FROM part)
SELECT tag, count(*) AS n FROM w GROUP BY tag ORDER BY n DESC, tag LIMIT 6""",
    "multi_turn_messages": """WITH t AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS rn FROM conversations WHERE text IS NOT NULL),
m AS (SELECT conv_id, rn, turn % 3 <> 0 AS kept, 'human=' || CASE WHEN rn = 1 THEN '<image><image>' ELSE '' END || 'Q' || turn || ';gpt=A' || turn AS s FROM t)
SELECT conv_id, CAST(2*count(*) FILTER (WHERE kept) AS INTEGER) AS n, coalesce(string_agg(s, ';' ORDER BY rn) FILTER (WHERE kept), '') AS turns FROM m GROUP BY conv_id""",
    "axis_flip": f"WITH {_RAW} SELECT scene_id, view_idx, {', '.join(f'{_r(f"({sign})*{n}_{k}")} AS {n}_{k}' for n, sign in (('right', 1), ('down', -1), ('fwd', -1), ('pos', _d(0.5))) for k in 'xyz')} FROM fx_views",
    "rendered_intrinsics": f"""WITH p AS (SELECT p_partkey, {_d(1.7)} + p_size/{_d(100)} AS a, (p_size*16 - 1)/{_d(2)} AS w, (p_size*12 - 1)/{_d(2)} AS h FROM part)
SELECT p_partkey, {_r('a*w')} AS fx, {_r('w')} AS cx, {_r(f'{_d(2.3)}*h')} AS fy, {_r('h')} AS cy FROM p""",
    "rotation_flags": "SELECT doc_id, coalesce(doc_id % 3 = 0 AND source IS NOT NULL OR starts_with(lower(trim(source)), 'arkitscenes'), false) AS rotated FROM documents",
    "mask_resize": f"""WITH {_RAW}, p AS (SELECT DISTINCT frame_id, obj_idx, u, v FROM fx_pixels), x AS (SELECT unnest(range(100)) AS t), y AS (SELECT unnest(range(30)) AS t)
SELECT frame_id, obj_idx, count(*) AS n, CAST(sum(x.t) AS BIGINT) AS su, CAST(sum(y.t) AS BIGINT) AS sv FROM p JOIN x ON CAST(floor((x.t + {_d(0.5)})*64/100) AS BIGINT) = p.u JOIN y ON CAST(floor((y.t + {_d(0.5)})*48/30) AS BIGINT) = p.v GROUP BY frame_id, obj_idx""",
    "parquet_scan": "SELECT 'labels.parquet' AS part, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS total FROM labels UNION ALL SELECT 'documents.parquet', count(*), CAST(sum(doc_id) AS BIGINT) FROM documents",
    "euler_angles": f"""WITH {_RAW} SELECT node_id, {', '.join(f"round(CASE WHEN round({c}, 6) <= round(-pi(), 6) THEN pi() ELSE {c} END, 6) AS {c}" for c in ('e0', 'e1', 'e2'))} FROM fx_objects""",
    "input_sizes": """WITH p AS (SELECT p_partkey, p_size*37 + 100 AS w, p_partkey % 900 + 80 AS h FROM part), q AS (SELECT p_partkey, CAST(round_even(h*518/CAST(w AS DOUBLE)/14, 0)*14 AS INTEGER) AS c,
  CASE WHEN w >= h THEN 518 ELSE CAST(round_even(w*518/CAST(h AS DOUBLE)/14, 0)*14 AS INTEGER) END AS pw, CASE WHEN w >= h THEN CAST(round_even(h*518/CAST(w AS DOUBLE)/14, 0)*14 AS INTEGER) ELSE 518 END AS ph FROM p)
SELECT p_partkey, c AS crop_height, greatest(c - 518, 0)//2 AS cut_top, least(c, 518) AS cut_height, pw AS pad_width, ph AS pad_height, greatest(518 - ph, 0)//2 AS top, greatest(518 - pw, 0)//2 AS left FROM q""",
    "checked_scenes": "SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n FROM lineitem GROUP BY l_orderkey HAVING l_orderkey % 2 = 0 OR count(*) <= 2",
    "resized_paths": "SELECT page_id, 'rgb/' || page_id || '_resized' || CASE WHEN page_id % 2 = 0 THEN '.jpg' ELSE '' END AS image FROM pages",
}
ORACLE["union_tasks"] = f"SELECT scene_id, CAST(n AS VARCHAR) AS answer, 'counting' AS task FROM ({ORACLE['duplicate_tag_count']}) UNION ALL SELECT scene_id, answer, 'camera_movement' FROM ({ORACLE['camera_movement']})"
