"""The isolation forest as SQL: the same samples, splits and paths from the same md5 numbers."""

from __future__ import annotations

TREES, SAMPLE, DEPTH = 100, 256, 8


def _path(n: str) -> str:
    return f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1e0) + 0.5772156649015329e0) - 2 * ({n} - 1e0) / {n} WHEN {n} = 2 THEN 1e0 ELSE 0e0 END"


def forest_sql(source: str, key: str, features: list[str], contamination: float, name: str = "iso", seed: int = 42) -> str:
    """Table expressions that end in ``name`` (k, iso_anomaly, iso_score, raw) over ``source``."""
    columns = [f"x{i}" for i in range(len(features))]
    xs = ", ".join(columns)
    chosen = lambda f: "CASE " + " ".join(f"WHEN {f} = {i} THEN {c}" for i, c in enumerate(columns)) + " END"
    usable = "list_filter([" + ", ".join(f"CASE WHEN max({c}) > min({c}) THEN {i} END" for i, c in enumerate(columns)) + "], lambda v: v IS NOT NULL)"
    word = lambda digest, at: f"('0x' || substr({digest}, {at}, 8))::BIGINT"
    out = [
        f"{name}_x AS MATERIALIZED (SELECT {key} AS k, {', '.join(f'coalesce(CAST({f} AS DOUBLE), 0) AS {c}' for f, c in zip(features, columns))},"
        f" md5('{seed}:' || coalesce(CAST({key} AS VARCHAR), '')) AS h FROM {source})",
        f"{name}_s0 AS MATERIALIZED (SELECT tree, CAST(0 AS BIGINT) AS slot, {xs} FROM (SELECT tree, {xs}, row_number() OVER (PARTITION BY tree"
        f" ORDER BY ({word('h', 1)} + tree * {word('h', 9)}) % 4294967291, k) AS r FROM {name}_x, range({TREES}) g(tree)) WHERE r <= {SAMPLE})",
        f"{name}_size AS MATERIALIZED (SELECT max(n) AS n FROM (SELECT count(*) AS n FROM {name}_s0 GROUP BY tree))",
    ]
    for d in range(DEPTH + 1):
        leaf = "true" if d == DEPTH else "n <= 1 OR len(u) = 0"
        spans = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in columns)
        out.append(
            f"{name}_n{d} AS MATERIALIZED (SELECT tree, slot, CASE WHEN {leaf} THEN -1 ELSE f END AS f, CASE WHEN {leaf} THEN 0e0 ELSE lo + {word('h', 9)} / 4294967296e0 * (hi - lo) END AS cut,"
            f" CASE WHEN {leaf} THEN CAST(round_even(({d} + {_path('n')}) / 1e-6, 0) AS BIGINT) ELSE 0 END AS path"
            f" FROM (SELECT *, {chosen('f').replace('THEN x', 'THEN lo_x')} AS lo, {chosen('f').replace('THEN x', 'THEN hi_x')} AS hi"
            f" FROM (SELECT *, u[CAST(floor({word('h', 1)} / 4294967296e0 * len(u)) AS BIGINT) + 1] AS f"
            f" FROM (SELECT tree, slot, count(*) AS n, {usable} AS u, {spans}, md5('{seed}:' || tree || ':' || slot) AS h FROM {name}_s{d} GROUP BY tree, slot))))")
        if d < DEPTH:
            out.append(f"{name}_s{d + 1} AS MATERIALIZED (SELECT s.tree, 2 * s.slot + 1 + CAST({chosen('f')} > cut AS BIGINT) AS slot, {xs} FROM {name}_s{d} s JOIN {name}_n{d} n ON s.tree = n.tree AND s.slot = n.slot WHERE f >= 0)")
    steps = f"SELECT DISTINCT {xs}, tree, CAST(0 AS BIGINT) AS slot FROM {name}_x, range({TREES}) g(tree)"
    out.append(f"{name}_r0 AS MATERIALIZED ({steps})")
    for d in range(DEPTH):
        out.append(f"{name}_r{d + 1} AS MATERIALIZED (SELECT r.tree, 2 * r.slot + 1 + CAST({chosen('f')} > cut AS BIGINT) AS slot, {xs} FROM {name}_r{d} r JOIN {name}_n{d} n ON r.tree = n.tree AND r.slot = n.slot WHERE f >= 0)")
    ends = " UNION ALL ".join(f"SELECT {xs}, path FROM {name}_r{d} r JOIN {name}_n{d} n ON r.tree = n.tree AND r.slot = n.slot WHERE f < 0" for d in range(DEPTH + 1))
    norm = f"greatest((SELECT {_path('n')} FROM {name}_size), 1e-9)"
    out += [
        f"{name}_p AS MATERIALIZED (SELECT {xs}, pow(2e0, -(sum(path)::DOUBLE * 1e-6) / {TREES} / {norm}) AS raw FROM ({ends}) GROUP BY {xs})",
        f"{name}_k AS MATERIALIZED (SELECT k, raw FROM {name}_x JOIN {name}_p USING ({xs}))",
        f"{name} AS MATERIALIZED (SELECT k, CAST(raw > q AS BIGINT) AS iso_anomaly, raw - q AS iso_score FROM {name}_k, (SELECT quantile_cont(raw, {1 - contamination}) AS q FROM {name}_k))",
    ]
    return ",\n".join(out)
