"""Common table expressions of the DuckDB counterparts of the queries."""

from __future__ import annotations

from ..functions.geometry import ANGLES, com_weights
from ..operators.series import hat
from ..schemas import JOINTS, KP, LIMB_JOINT, LIMBS

EV = "ev AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INT AS i, value AS x, event_type, event_id FROM events)"
W = "WINDOW w AS (PARTITION BY user_id ORDER BY i)"


def with_(*ctes: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' * recursive}" + ",\n".join(ctes) + "\n"


def latch(by: str, on: str, off: str, on_rows: int, off_rows: int, name: str = "s") -> str:
    """An expression pair for a latch: needs columns on_ok and off_ok, windows over ``by``."""
    w = lambda k: f"OVER (PARTITION BY {by} ORDER BY i ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    change = f"CASE WHEN count(*) {w(on_rows)} = {on_rows} AND bool_and({on}) {w(on_rows)} THEN true WHEN count(*) {w(off_rows)} = {off_rows} AND bool_and({off}) {w(off_rows)} THEN false END"
    return change


def held(by: str, change: str = "change") -> str:
    return f"coalesce(last_value({change} IGNORE NULLS) OVER (PARTITION BY {by} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false)"


def kp() -> str:
    return f"""numbered AS (SELECT label::VARCHAR AS clip_id, vec_id, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)::INT AS i, embedding AS e FROM embeddings),
kp AS (SELECT clip_id, vec_id, i, j::INT AS joint, 540 + 400 * e[3 * j + 1]::DOUBLE AS x, 800 + 400 * e[3 * j + 2]::DOUBLE AS y, least(1.0, 4 * abs(e[3 * j + 3]::DOUBLE)) AS c FROM numbered, range(17) t(j))"""


def filled() -> str:
    def lerp(c: str) -> str:
        return f"""CASE WHEN n < 2 THEN NULL WHEN b IS NULL THEN a.{c} WHEN a IS NULL OR a.i = b.i THEN b.{c} ELSE b.{c} + (a.{c} - b.{c}) * (i - b.i) / (a.i - b.i) END AS {c}"""

    return f"""sure AS (SELECT clip_id, joint, i, CASE WHEN c >= 0.3 THEN {{'i': i, 'x': x, 'y': y, 'c': c}} END AS p FROM kp),
near AS (SELECT clip_id, joint, i, count(p) OVER (PARTITION BY clip_id, joint) AS n,
  last_value(p IGNORE NULLS) OVER (PARTITION BY clip_id, joint ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b,
  first_value(p IGNORE NULLS) OVER (PARTITION BY clip_id, joint ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM sure),
filled AS (SELECT clip_id, joint, i, {lerp('x')}, {lerp('y')}, {lerp('c')} FROM near)"""


def smoothed(src: str, by: str, cols: tuple[str, ...], name: str = "smoothed", window: int = 9) -> str:
    sizes = range(5, window + 1, 2)
    table = " ".join(f"WHEN {s} THEN [{', '.join('[' + ', '.join(repr(float(v)) for v in row) + ']' for row in hat(s))}]" for s in sizes)
    near = ", ".join(f"list(coalesce({c}, 0.0)) OVER (PARTITION BY {by} ORDER BY i ROWS BETWEEN {window - 1} PRECEDING AND {window - 1} FOLLOWING) AS near_{c}" for c in cols)
    fits = ", ".join(f"CASE WHEN w < 5 THEN coalesce({c}, 0.0) ELSE list_dot_product(near_{c}[low - first + 1 : low - first + w], rows[i - low + 1]) END AS {c}" for c in cols)
    return f"""{name}_n AS (SELECT *, least({window}, CASE WHEN n % 2 = 1 THEN n ELSE n - 1 END)::INT AS w FROM (SELECT *, count(*) OVER (PARTITION BY {by}) AS n, {near} FROM {src})),
{name}_at AS (SELECT *, greatest(least(i - w // 2, n - w), 0)::INT AS low, greatest(i - {window - 1}, 0) AS first, CASE w {table} END AS rows FROM {name}_n),
{name} AS (SELECT {by}, i, {fits} FROM {name}_at)"""


def body() -> str:
    """One row per frame with smoothed joints as columns, torso, stand_y and com."""
    cols = ", ".join(f"max({v}) FILTER (joint = {k}) AS {n}_{v}" for n, k in KP.items() for v in "xy")
    com = lambda v: "0.0 + " + " + ".join(f"{n}_{v} * {w!r}" for n, w in zip(JOINTS, com_weights(), strict=True))
    return f"""wide AS (SELECT clip_id, i, {cols} FROM smoothed GROUP BY clip_id, i),
posed AS (SELECT *, {com('x')} AS com_x, {com('y')} AS com_y, (lhip_y + rhip_y) / 2 AS hip_y, sqrt(((lsho_x + rsho_x) / 2 - (lhip_x + rhip_x) / 2) ** 2 + ((lsho_y + rsho_y) / 2 - (lhip_y + rhip_y) / 2) ** 2) AS d FROM wide),
scale AS (SELECT clip_id, quantile_cont(d, 0.5) AS torso, quantile_cont(hip_y, 0.9) AS stand_y, count(*) AS n_frames FROM posed GROUP BY clip_id),
framed AS (SELECT p.*, torso, stand_y, hip_y < stand_y - 0.6 * torso AS climbing FROM posed p JOIN scale USING (clip_id))"""


def pose() -> str:
    return ",\n".join([kp(), filled(), smoothed("filled", "clip_id, joint", ("x", "y")), body()])


def angle(a: str, b: str, c: str) -> str:
    u = lambda p, v: f"({p}_{v} - {b}_{v})"
    dot = f"{u(a, 'x')} * {u(c, 'x')} + {u(a, 'y')} * {u(c, 'y')}"
    norm = lambda p: f"sqrt({u(p, 'x')} ** 2 + {u(p, 'y')} ** 2)"
    return f"degrees(acos(greatest(least(({dot}) / greatest({norm(a)} * {norm(c)}, 1e-9), 1.0), -1.0)))"


def angles() -> dict[str, str]:
    return {f"{s}{name}": angle(*(f"{s}{j}" for j in around)) for name, around in ANGLES.items() for s in "lr"}


def contacts(on_t: float, off_t: float) -> str:
    """Frames with limb speeds and contacts, step by step."""
    raw, med, flags, on = [], [], [], []
    for limb in LIMBS:
        j = LIMB_JOINT[limb]
        end = lambda v, k: f"coalesce({'lead' if k > 0 else 'lag'}({j}_{v}, {abs(k)}) OVER w, {'last' if k > 0 else 'first'}_value({j}_{v}) OVER (PARTITION BY clip_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"  # noqa: B023, E731
        secs = "((least(i + 5, n_all - 1) - greatest(i - 5, 0)) / 30.0)"
        raw.append(f"sqrt(({end('x', 5)} - {end('x', -5)}) ** 2 + ({end('y', 5)} - {end('y', -5)}) ** 2) / nullif({secs}, 0) / greatest(torso, 1e-6) AS {limb}_raw")
        idx = lambda k: f"series_{limb}[CASE WHEN i + {k} < 0 THEN -(i + {k}) ELSE CASE WHEN i + {k} > n_all - 1 THEN 2 * n_all - (i + {k}) ELSE i + {k} + 1 END END]"  # noqa: B023, E731
        med.append(f"coalesce(list_sort([{', '.join(idx(k) for k in (-2, -1, 0, 1, 2))}])[3], 99.0) AS {limb}_speed")
        flags.append(latch("clip_id", f"{limb}_speed < {on_t}", f"{limb}_speed > {off_t}", 4, 3) + f" AS {limb}_change")
        on.append(held("clip_id", f"{limb}_change") + f" AS {limb}")
    return f"""sped AS (SELECT *, {', '.join(raw)} FROM (SELECT *, count(*) OVER (PARTITION BY clip_id) AS n_all FROM framed) WINDOW w AS (PARTITION BY clip_id ORDER BY i)),
listed AS (SELECT *, {', '.join(f'list({limb}_raw) OVER (PARTITION BY clip_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS series_{limb}' for limb in LIMBS)} FROM sped),
calm AS (SELECT * EXCLUDE ({', '.join(f'series_{limb}' for limb in LIMBS)}), {', '.join(med)} FROM listed),
changed AS (SELECT *, {', '.join(flags)} FROM calm),
touching AS (SELECT *, {', '.join(on)} FROM changed)"""


def states() -> str:
    """Frames with state, support and barn-door arm."""
    pts = ", ".join(f"{{'k': {k}, 'on': {limb}, 'x': {LIMB_JOINT[limb]}_x, 'y': {LIMB_JOINT[limb]}_y, 'hand': {str(k < 2).lower()}}}" for k, limb in enumerate(LIMBS))
    cross = lambda a, b, p: f"(({b}.x - {a}.x) * ({p}_y - {a}.y) - ({b}.y - {a}.y) * ({p}_x - {a}.x))"
    norm = lambda a, b: f"sqrt(({b}.x - {a}.x) ** 2 + ({b}.y - {a}.y) ** 2)"
    line = lambda a, b: f"abs({cross(a, b, 'com')}) / greatest({norm(a, b)}, 1e-9)"
    area = "(q2.x - q1.x) * (q3.y - q1.y) - (q2.y - q1.y) * (q3.x - q1.x)"
    u = "((com_x - q1.x) * (q3.y - q1.y) - (com_y - q1.y) * (q3.x - q1.x)) / nullif(area, 0)"
    v = "((q2.x - q1.x) * (com_y - q1.y) - (q2.y - q1.y) * (com_x - q1.x)) / nullif(area, 0)"
    t = "greatest(0.0, least(1.0, ((com_x - p1.x) * (p2.x - p1.x) + (com_y - p1.y) * (p2.y - p1.y)) / nullif((p2.x - p1.x) ** 2 + (p2.y - p1.y) ** 2, 0)))"
    return f"""limbs_on AS (SELECT *, list_filter([{pts}], lambda p: p.on) AS pts, lh::INT + rh::INT + lf::INT + rf::INT AS n FROM touching),
stated AS (SELECT *, CASE WHEN NOT climbing THEN 'idle' WHEN n >= 4 THEN '4pt' WHEN n = 3 THEN '3pt' WHEN n = 2 THEN '2pt' ELSE '1pt' END AS state FROM limbs_on),
began AS (SELECT *, last_value(CASE WHEN i = 0 OR state IS DISTINCT FROM prev THEN i / 30.0 END IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st_t0 FROM (SELECT *, lag(state) OVER (PARTITION BY clip_id ORDER BY i) AS prev FROM stated)),
picked AS (SELECT *, CASE WHEN n = 3 THEN pts WHEN n >= 4 THEN list_sort(list_transform(pts, lambda p: {{'s': p.y, 't': p.x, 'x': p.x, 'y': p.y}}))[1:3].list_transform(lambda p: {{'k': 0, 'on': true, 'x': p.x, 'y': p.y, 'hand': false}}) END AS tri, list_filter(pts, lambda p: p.hand = (len(list_filter(pts, lambda q: q.hand)) >= 2)) AS same FROM began),
corners AS (SELECT *, tri[1] AS q1, tri[2] AS q2, tri[3] AS q3, pts[1] AS p1, pts[2] AS p2, same[1] AS s1, same[2] AS s2 FROM picked),
areas AS (SELECT *, {area} AS area FROM corners),
inner_ AS (SELECT *, {u} AS u, {v} AS v FROM areas),
supported AS (SELECT *,
  CASE WHEN state IN ('3pt', '4pt') THEN CASE WHEN area ** 2 < 1e-9 THEN false ELSE u >= 0 AND v >= 0 AND u + v <= 1 END WHEN state = '2pt' THEN false END AS inside,
  CASE WHEN state IN ('3pt', '4pt') THEN CASE WHEN area ** 2 < 1e-9 THEN 0.0 ELSE least({line('q1', 'q2')}, {line('q2', 'q3')}, {line('q3', 'q1')}) END
       WHEN state = '2pt' THEN CASE WHEN {norm('p1', 'p2')} < 1e-9 THEN sqrt((com_x - p1.x) ** 2 + (com_y - p1.y) ** 2) ELSE sqrt((com_x - p1.x - {t} * (p2.x - p1.x)) ** 2 + (com_y - p1.y - {t} * (p2.y - p1.y)) ** 2) END END / torso AS margin,
  CASE WHEN state = '3pt' AND len(same) = 2 THEN {line('s1', 's2')} / torso ELSE 0.0 END AS bd FROM inner_)"""


def limb_rows() -> str:
    """Contacts of analysed frames, one row per limb."""
    rows = " UNION ALL ".join(f"SELECT clip_id, i, '{limb}' AS limb, {k} AS rank, {limb} AS \"on\" FROM touching" for k, limb in enumerate(LIMBS))
    return f"lb AS ({rows})"


def phases(fps: float = 30.0, width: int = 9) -> str:
    """Phases of techniques, from frames with contacts."""
    d = angles()
    kinds: list[tuple[str, str, str, float, str, str]] = [("side_on", "", "so", 0.8, "NULL::DOUBLE", "0.5 + sec / 4")]
    for s, side in (("l", "左"), ("r", "右")):
        o = "r" if s == "l" else "l"
        off = lambda j: f"abs({s}{j}_x - mx)"  # noqa: B023, E731
        kinds += [
            ("drop_knee", side, f"climbing AND {s}f AND {off('knee')} + 0.08 * t < least({off('hip')}, {off('ank')}) AND {s}knee_deg < 155", 0.5, "NULL", "0.55 + sec / 3"),
            ("lock_off", f"{side}手", f"climbing AND {s}h AND NOT {o}h AND {s}el_deg < 82", 0.6, "NULL", "0.55 + sec / 2"),
            ("knee_bar", side, f"climbing AND NOT {s}f AND sqrt(({s}ank_x - {o}knee_x) ** 2 + ({s}ank_y - {o}knee_y) ** 2) < 0.18 * t AND abs({s}ank_y - {o}knee_y) < 0.15 * t", 0.6, "NULL", "0.6"),
            ("heel_hook", side, f"climbing AND {s}f AND ({s}knee_y - {s}ank_y) / t > 0.25 AND {s}knee_deg < 175", 0.5, f"({s}knee_y - {s}ank_y) / t", "0.5 + top / 1.5"),
            ("flagging", side, f"climbing AND NOT {s}f AND {o}f AND ({s}ank_x < least(lwr_x, rwr_x, {o}ank_x) - 0.5 * t OR {s}ank_x > greatest(lwr_x, rwr_x, {o}ank_x) + 0.5 * t) AND {s}knee_deg > 150", 0.5, "NULL", "0.5 + sec / 2"),
        ]
    kinds += [
        ("cross_feet", "", "cf", 0.3, "cr / t", "0.4 + top"),
        ("match_hands", "", "climbing AND lh AND rh AND (lf OR rf) AND sqrt((lwr_x - rwr_x) ** 2 + (lwr_y - rwr_y) ** 2) / t < 0.28", 0.4, "NULL", "0.6 + sec / 3"),
        ("straight_arm", "", "climbing AND (lh OR rh) AND lel_deg > 158 AND rel_deg > 158", 1.0, "NULL", "0.5 + sec / 4"),
    ]
    rows = ", ".join(f"{{'kind': {k}, 'raw': coalesce({mask}, false), 'm': ({measure})::DOUBLE}}" for k, (_, _, mask, _, measure, _) in enumerate(kinds))
    pick = lambda at: "CASE kind " + " ".join(f"WHEN {k} THEN {at(v)}" for k, v in enumerate(kinds)) + " END"
    k = width // 2
    return f"""tf AS (SELECT t.*, {', '.join(f'{d[a]} AS {a}_deg' for a in ('lel', 'rel', 'lknee', 'rknee'))}, greatest(torso, 1e-6) AS t, (lhip_x + rhip_x) / 2 AS mx, -sign(fo) * (lank_x - rank_x) AS cr FROM touching t JOIN (SELECT clip_id, quantile_cont(lank_x - rank_x, 0.5) AS fo FROM touching GROUP BY clip_id) m USING (clip_id)),
th AS (SELECT *, CASE WHEN climbing AND (lh OR rh) AND abs(lsho_x - rsho_x) / t < 0.38 THEN true WHEN abs(lsho_x - rsho_x) / t > 0.48 THEN false END AS c1, CASE WHEN climbing AND cr > 0.06 * t THEN true WHEN NOT cr > -0.05 * t THEN false END AS c2 FROM tf),
ti AS (SELECT *, {held('clip_id', 'c1')} AS so, {held('clip_id', 'c2')} AS cf FROM th),
tj AS (SELECT clip_id, i, v.kind AS kind, v.raw AS raw, v.m AS m FROM (SELECT clip_id, i, unnest([{rows}]) AS v FROM ti)),
tk AS (SELECT *, list(raw::INT) OVER (PARTITION BY clip_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM tj),
tl AS (SELECT clip_id, kind, i, m, list_sum([l[CASE WHEN i + k < 0 THEN -(i + k) WHEN i + k > len(l) - 1 THEN 2 * len(l) - (i + k) ELSE i + k + 1 END] FOR k IN range({-k}, {k + 1})]) / {width}.0 > 0.6 AS ok FROM tk),
tm AS (SELECT clip_id, kind, min(i) AS a, max(i) AS b, max(m) AS top, (max(i) - min(i)) / {fps} AS sec FROM (SELECT *, i - row_number() OVER (PARTITION BY clip_id, kind ORDER BY i) AS g FROM tl WHERE ok) GROUP BY clip_id, kind, g HAVING count(*) >= 3 AND count(*) / {fps} >= {pick(lambda v: v[3])}),
ph AS (SELECT clip_id, {pick(lambda v: f"'{v[0]}'")} AS name, round(a / {fps}, 2) AS t0, round(b / {fps}, 2) AS t1, {pick(lambda v: f"'{v[1]}'")} AS side, round(least(1.0, {pick(lambda v: v[5])}), 2) AS conf FROM tm)"""


def dynos(fps: float = 30.0) -> str:
    return f"""dm AS (SELECT clip_id, i, climbing, torso, NOT (lf OR rf) AS off, sum(com_y) OVER (PARTITION BY clip_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5 AS y FROM touching),
dv AS (SELECT *, CASE WHEN lag(y) OVER w IS NULL THEN coalesce(lead(y) OVER w - y, 0) WHEN lead(y) OVER w IS NULL THEN y - lag(y) OVER w ELSE (lead(y) OVER w - lag(y) OVER w) / 2 END * {fps} / greatest(torso, 1e-6) AS vy FROM dm WINDOW w AS (PARTITION BY clip_id ORDER BY i)),
dr AS (SELECT *, i - row_number() OVER (PARTITION BY clip_id ORDER BY i) AS g FROM dv WHERE off),
da AS (SELECT *, min(CASE WHEN climbing THEN i END) OVER (PARTITION BY clip_id, g) AS a FROM dr),
dy AS (SELECT clip_id, 'dyno' AS name, round(a / {fps}, 2) AS t, '' AS side, round(least(1.0, 0.5 - min(vy) / 2), 2) AS conf FROM da WHERE i >= a GROUP BY clip_id, g, a HAVING count(*) >= {int(0.25 * fps)} AND min(vy) < -1.0)"""


def transfers(fps: float = 30.0) -> str:
    """Transfers from merged spans ``mg`` (limbs, a, b) and frames ``supported``."""
    at = lambda name, key: f"JOIN supported {name} ON {name}.clip_id = m.clip_id AND {name}.i = greatest(0, least(last, {key}))"
    return f"""ls AS (SELECT clip_id, max(i) AS last FROM supported GROUP BY clip_id),
tr AS (SELECT m.clip_id, m.a, m.b, limbs, (c1.com_x - c0.com_x) / c0.torso AS dx, (c1.com_y - c0.com_y) / c0.torso AS dy, s0.state AS s0, s1.state AS s1 FROM mg m JOIN ls ON ls.clip_id = m.clip_id {at('fa', 'm.a')} {at('fb', 'm.b')} {at('c0', f'm.a - {int(0.4 * fps)}')} {at('c1', f'm.b + {int(0.6 * fps)}')} {at('s0', 'm.a - 1')} {at('s1', 'm.b + 2')} WHERE fa.climbing OR fb.climbing)"""
