"""DuckDB SQL for the forest queries: the same algorithm written as SQL, levels unrolled.

Columns x0..x4 stand for the feature array; ``CASE f WHEN ...`` picks one.
"""

from __future__ import annotations

from sylvan.functions.hashing import sql_uniform
from sylvan.functions import params as P
from sylvan.plans.basic import RID_SQL
from sylvan.plans.forest import N_FEATURES, ForestConfig
from sylvan.operators.forest import CLASSES, VOTE_SCALE, stat_columns

XS = [f"x{i}" for i in range(N_FEATURES)]


def _x_of(f: str, alias: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {alias}.{x}" for i, x in enumerate(XS))
    return f"(CASE {f} {arms} END)"


def _open(cfg: ForestConfig, depth, n: str, sums: list[str], prefix: str = "") -> str:
    pure = f" AND NOT ({sums[0]} = 0 OR {sums[0]} = {n})" if cfg.task == "clf" else ""
    if cfg.task == CLASSES:
        pure = " AND NOT (" + " OR ".join(f"{s} = {n}" for s in sums) + ")"
    return f"({depth} < {prefix}max_depth AND {n} >= 2 * {prefix}min_leaf{pure})"


def _dbl(v: float) -> str:
    return f"{v!r}::DOUBLE"


def _rate(cfg: ForestConfig) -> str:
    if cfg.max_rows is None:
        return _dbl(cfg.max_p)
    return f"least({_dbl(cfg.max_p)}, {_dbl(float(cfg.max_rows))} / CAST(count(*) AS DOUBLE))"


def base_ctes(cfg: ForestConfig) -> list[str]:
    seed = cfg.seed
    y_of_feat, classes, class_join = "b.y", [], ""
    if cfg.task == CLASSES:
        y = "l_returnflag"
        y_of_feat, class_join = "c.number AS y", " JOIN cls c ON c.flag = b.y"
        classes = ["""cls AS (SELECT flag, row_number() OVER (ORDER BY n DESC, flag) - 1 AS number
  FROM (SELECT y AS flag, count(*) AS n FROM base WHERE is_train GROUP BY y))"""]
    elif cfg.task == "clf":
        y = "CAST(l_returnflag = 'R' AS BIGINT)"
    else:
        y = "CAST(round(l_extendedprice * 100.0::DOUBLE) AS BIGINT)"
    grid = ", ".join(f"('{k}', {p['min_samples_leaf']}, {p['max_depth']})" for k, p in P.grid_points(cfg.grid))
    u_split = sql_uniform("split", seed, "rid")
    u_col = sql_uniform("col", seed, "k", "tree", "f")
    u_pick = sql_uniform("pick", seed, "k", "tree", "f")
    block_key = (f"concat_ws('|', 'row', '{seed}', CAST(t.rid AS VARCHAR), CAST(g.k AS VARCHAR), "
                 f"CAST((g.tree - 1) // 4 AS VARCHAR))")
    u_row = (f"(CAST(('0x' || substr(md5({block_key}), 8 * ((g.tree - 1) % 4) + 1, 8)) AS BIGINT) "
             f"/ 4294967296.0::DOUBLE)")
    xs = ", ".join(f"t.{x}" for x in XS)
    min_cols = min(cfg.min_cols, N_FEATURES)
    return [
        f"""base0 AS (
  SELECT {RID_SQL} AS rid, {y} AS y,
    CAST(l_linenumber AS DOUBLE) AS x0, CAST(l_quantity AS DOUBLE) AS x1,
    CAST(l_discount AS DOUBLE) AS x2, CAST(l_tax AS DOUBLE) AS x3, l_linestatus AS s4
  FROM lineitem
  WHERE l_linenumber IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL
    AND l_tax IS NOT NULL AND l_linestatus IS NOT NULL AND l_returnflag IS NOT NULL
    AND l_extendedprice IS NOT NULL)""",
        f"base AS (SELECT *, {u_split} < {_dbl(cfg.train_share)} AS is_train FROM base0)",
        """sidx AS (
  SELECT s4, CAST(row_number() OVER (ORDER BY cnt DESC, s4) - 1 AS DOUBLE) AS x4
  FROM (SELECT s4, count(*) AS cnt FROM base WHERE is_train GROUP BY s4))""",
        *classes,
        f"feat AS (SELECT b.rid, {y_of_feat}, b.is_train, b.x0, b.x1, b.x2, b.x3, sidx.x4 "
        f"FROM base b JOIN sidx ON b.s4 = sidx.s4{class_join})",
        "train AS (SELECT * FROM feat WHERE is_train)",
        "test AS (SELECT * FROM feat WHERE NOT is_train)",
        f"""prate AS (
  SELECT count(*) AS n_train, {_rate(cfg)} AS p
  FROM train)""",
        f"grid(k, min_leaf, max_depth) AS (VALUES {grid})",
        f"gt AS (SELECT grid.k, grid.min_leaf, grid.max_depth, CAST(t.range AS INTEGER) AS tree "
        f"FROM grid, range(1, {cfg.n_trees + 1}) t)",
        f"mf AS (SELECT gt.k, gt.tree, CAST(fr.range AS INTEGER) AS f FROM gt, range(0, {N_FEATURES}) fr)",
        f"mc AS (SELECT k, tree, f, {u_col} < {_dbl(cfg.col_p)} AS chosen, {u_pick} AS u2 FROM mf)",
        """mr AS (SELECT *, sum(CAST(chosen AS INTEGER)) OVER (PARTITION BY k, tree) AS n_chosen,
  row_number() OVER (PARTITION BY k, tree ORDER BY u2, f) AS pick_rank FROM mc)""",
        f"mask AS (SELECT k, tree, f FROM mr WHERE chosen OR pick_rank <= {min_cols} - n_chosen)",
        f"""sampled AS (
  SELECT g.k, g.tree, g.min_leaf, g.max_depth, t.rid, t.y, {xs}
  FROM train t CROSS JOIN gt g CROSS JOIN prate
  WHERE {u_row} < prate.p)""",
    ]


def level_ctes(cfg: ForestConfig) -> list[str]:
    xs = ", ".join(f"r.{x}" for x in XS)
    stats = stat_columns(cfg.n_classes)
    counted = ", ".join(f"CAST(sum(CAST(r.y = {c} AS INTEGER)) AS BIGINT) AS {s}" if cfg.n_classes else f"CAST(sum(r.y) AS BIGINT) AS {s}"
                        for c, s in enumerate(stats))
    windowed = ", ".join(f"CAST(sum({s}) OVER wr AS BIGINT) AS {s}_l, CAST(sum({s}) OVER wf AS BIGINT) AS {s}_t" for s in stats)
    sides = ", ".join(f"{s}_l, {s}_t - {s}_l AS {s}_r" for s in stats)
    left, right, total = ([f"{s}_{side}" for s in stats] for side in "lrt")

    def squares(of: list[str]) -> str:
        return "(" + " + ".join(f"CAST({s} AS DOUBLE) * CAST({s} AS DOUBLE)" for s in of) + ")"

    out = [f"s0 AS (SELECT k, tree, min_leaf, max_depth, rid, y, {', '.join(XS)}, 1 AS node FROM sampled)"]
    for d in range(cfg.depth):
        out.append(f"""h{d} AS (
  SELECT r.k, r.tree, r.node, r.min_leaf, r.max_depth, m.f, {_x_of('m.f', 'r')} AS v,
    count(*) AS n, {counted}
  FROM s{d} r JOIN mask m ON m.k = r.k AND m.tree = r.tree
  GROUP BY r.k, r.tree, r.node, r.min_leaf, r.max_depth, m.f, v)""")
        out.append(f"""c{d} AS (
  SELECT *,
    CAST(sum(n) OVER wr AS BIGINT) AS nl, CAST(sum(n) OVER wf AS BIGINT) AS nt, {windowed},
    lead(v) OVER (PARTITION BY k, tree, node, f ORDER BY v) AS v_next
  FROM h{d}
  WINDOW wf AS (PARTITION BY k, tree, node, f),
         wr AS (PARTITION BY k, tree, node, f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
        out.append(f"""b{d} AS (
  SELECT k, tree, node, min_leaf, max_depth, f, thr, nl, nr, {', '.join(left + right)},
    {_open(cfg, d + 1, 'nl', left)} AS open_left, {_open(cfg, d + 1, 'nr', right)} AS open_right
  FROM (
    SELECT *, {squares(left)} / nl + {squares(right)} / nr AS score
    FROM (SELECT k, tree, node, min_leaf, max_depth, f, v_next, nl, nt, nt - nl AS nr, {sides}, {', '.join(total)},
            (v + v_next) / 2.0::DOUBLE AS thr FROM c{d})
    WHERE v_next IS NOT NULL AND nl >= min_leaf AND nr >= min_leaf AND {_open(cfg, d, 'nt', total)}
  )
  QUALIFY row_number() OVER (PARTITION BY k, tree, node ORDER BY score DESC, f, thr) = 1)""")
        if d + 1 < cfg.depth:
            xf = _x_of("b.f", "r")
            out.append(f"""s{d + 1} AS (
  SELECT r.k, r.tree, r.min_leaf, r.max_depth, r.rid, r.y, {xs},
    2 * r.node + CAST({xf} > b.thr AS INTEGER) AS node
  FROM s{d} r JOIN b{d} b ON b.k = r.k AND b.tree = r.tree AND b.node = r.node
  WHERE CASE WHEN {xf} > b.thr THEN b.open_right ELSE b.open_left END)""")

    def named(side: str) -> str:
        return ", ".join(f"{s}_{side} AS {s}" for s in stats)

    born = [f"SELECT k, tree, node, 0 AS depth, n, {', '.join(stats)} FROM tot0"]
    splits = []
    for d in range(cfg.depth):
        born.append(f"SELECT k, tree, 2 * node AS node, {d + 1} AS depth, nl AS n, {named('l')} FROM b{d}")
        born.append(f"SELECT k, tree, 2 * node + 1 AS node, {d + 1} AS depth, nr AS n, {named('r')} FROM b{d}")
        splits.append(f"SELECT k, tree, node, f, thr FROM b{d}")
    scale = _dbl(VOTE_SCALE[cfg.task])
    votes = ", ".join(f"CAST(floor(CAST(b.{s} AS DOUBLE) * {scale} / b.n + 0.5::DOUBLE) AS BIGINT) AS vote{s[1:]}" for s in stats)
    out += [
        f"""tot0 AS (SELECT k, tree, node, max(n) AS n, {', '.join(f'max({s}) AS {s}' for s in stats)} FROM (
  SELECT k, tree, node, f, CAST(sum(n) AS BIGINT) AS n, {', '.join(f'CAST(sum({s}) AS BIGINT) AS {s}' for s in stats)}
  FROM h0 GROUP BY k, tree, node, f
) GROUP BY k, tree, node)""",
        "born AS (" + "\n  UNION ALL ".join(born) + ")",
        "splits AS (" + "\n  UNION ALL ".join(splits) + ")",
        f"""nodes AS (
  SELECT b.k, b.tree, b.node, b.depth, b.n, {', '.join(f'b.{s}' for s in stats)}, sp.f, sp.thr, sp.f IS NULL AS is_leaf,
    {votes}
  FROM born b LEFT JOIN splits sp ON sp.k = b.k AND sp.tree = b.tree AND sp.node = b.node)""",
    ]
    return out


def scoring_ctes(cfg: ForestConfig) -> list[str]:
    xs = ", ".join(f"r.{x}" for x in XS)
    out = [f"""rt0 AS (SELECT r.rid, r.y, {xs}, tr.k, tr.tree, 1 AS node
  FROM test r CROSS JOIN (SELECT k, tree FROM nodes WHERE node = 1) tr)"""]
    for d in range(cfg.depth):
        xf = _x_of("nd.f", "r")
        out.append(f"""rt{d + 1} AS (
  SELECT r.rid, r.y, {xs}, r.k, r.tree,
    CASE WHEN nd.f IS NULL THEN r.node ELSE 2 * r.node + CAST({xf} > nd.thr AS INTEGER) END AS node
  FROM rt{d} r LEFT JOIN (SELECT * FROM nodes WHERE depth = {d} AND NOT is_leaf) nd
    ON nd.k = r.k AND nd.tree = r.tree AND nd.node = r.node)""")
    out.append(f"""leafs AS (
  SELECT r.rid, r.y, r.k, r.tree, r.node, {', '.join('nd.vote' + c[1:] for c in stat_columns(cfg.n_classes))} FROM rt{cfg.depth} r
  JOIN nodes nd ON nd.k = r.k AND nd.tree = r.tree AND nd.node = r.node WHERE nd.is_leaf)""")
    score = "CAST(sum(vote) AS BIGINT) AS score"
    if cfg.n_classes:
        score = "[" + ", ".join(f"CAST(sum(vote{c}) AS BIGINT)" for c in range(cfg.n_classes)) + "] AS scores"
    out.append(f"""votes AS (
  SELECT rid, y, k, {score}, count(*) AS n_trees FROM leafs GROUP BY rid, y, k)""")
    return out


def metric_ctes(cfg: ForestConfig) -> list[str]:
    if cfg.task == CLASSES:
        total = f"(CAST(n_trees AS DOUBLE) * {_dbl(VOTE_SCALE[CLASSES])})"
        return [
            f"""scored AS (SELECT *, list_transform(scores, lambda s: CAST(s AS DOUBLE) / {total}) AS probability,
  list_position(scores, list_max(scores)) - 1 AS number FROM votes)""",
            "accuracy AS (SELECT k, CAST(sum(CAST(number = y AS INTEGER)) AS DOUBLE) / count(*) AS accuracy FROM scored GROUP BY k)",
            "best AS (SELECT k, accuracy FROM accuracy ORDER BY accuracy DESC NULLS LAST, k LIMIT 1)",
        ]
    if cfg.task == "clf":
        total = f"(CAST(n_trees AS DOUBLE) * {_dbl(VOTE_SCALE['clf'])})"
        return [
            f"""scored AS (SELECT *, CAST(score AS DOUBLE) / {total} AS prob,
  CASE WHEN CAST(score AS DOUBLE) * 2.0::DOUBLE > {total} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM votes)""",
            "sc AS (SELECT k, score, sum(y) AS pos, sum(1 - y) AS neg FROM votes GROUP BY k, score)",
            """cm AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY k ORDER BY score
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sc)""",
            """auc AS (SELECT k,
  CASE WHEN sum(CAST(pos AS DOUBLE)) * sum(CAST(neg AS DOUBLE)) > 0 THEN
    sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0::DOUBLE))
      / (sum(CAST(pos AS DOUBLE)) * sum(CAST(neg AS DOUBLE))) END AS auc
  FROM cm GROUP BY k)""",
            "best AS (SELECT k, auc FROM auc ORDER BY auc DESC NULLS LAST, k LIMIT 1)",
        ]
    scale = int(VOTE_SCALE["reg"])
    resid = f"CAST(score - {scale} * n_trees * y AS HUGEINT)"
    den = f"(pow(CAST(max(n_trees) AS DOUBLE), 2) * {_dbl(VOTE_SCALE['reg'] ** 2 * 100.0 ** 2)} * CAST(count(*) AS DOUBLE))"
    return [
        f"mse AS (SELECT k, round(CAST(sum({resid} * {resid}) AS DOUBLE) / {den}, 2) AS mse FROM votes GROUP BY k)",
        "best AS (SELECT k, mse FROM mse ORDER BY mse ASC NULLS LAST, k LIMIT 1)",
    ]


def forest_sql(cfg: ForestConfig, final: str, scoring: bool = True, growth: bool = True, more: list[str] = ()) -> str:
    ctes = base_ctes(cfg) + (level_ctes(cfg) if growth else []) + list(more)
    if scoring:
        ctes += scoring_ctes(cfg) + metric_ctes(cfg)
    return "WITH " + ",\n".join(ctes) + "\n" + final
