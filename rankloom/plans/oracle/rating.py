"""DuckDB SQL for ratings, neighbours and factorisation."""

from __future__ import annotations

from rankloom.plans.oracle.views import compose

CENTRED = compose(
    ["ratings"], {}, "SELECT user_id, item_id, fold, CAST(rating - 3 AS DOUBLE) AS rating FROM ratings"
)
NEUTRAL = CENTRED + " WHERE rating <> 3"
MATRIX = compose(
    ["ratings"], {}, "SELECT user_id, item_id, CAST(sum(rating) AS BIGINT) AS rating FROM ratings GROUP BY 1, 2"
)
ENTITIES = compose(
    ["ratings"], {},
    """SELECT 'user' AS side, count(DISTINCT user_id) AS n FROM ratings
       UNION ALL SELECT 'item', count(DISTINCT item_id) FROM ratings""",
)
SCALE_UNIT = compose(["ratings"], {}, "SELECT user_id, item_id, fold, (rating - 1) / 4.0 AS unit FROM ratings")
MASK = compose(["train"], {}, "SELECT user_id, item_id FROM train WHERE rating <> 0")
ENTITY_MEAN = compose(
    ["train", "users"], {},
    """SELECT user_id AS id, round(sum(rating) / (SELECT count(*) FROM users), 9) + 0.0 AS mean FROM train GROUP BY 1""",
)
L2_NORMS = compose(["train"], {}, "SELECT item_id AS id, round(sqrt(sum(rating * rating)), 9) AS l2 FROM train GROUP BY 1")


def group(entity: str) -> str:
    return compose(
        ["pairs"], {},
        f"SELECT p.*, s.targets FROM pairs p JOIN (SELECT {entity}, count(*) AS targets FROM pairs GROUP BY 1) s USING ({entity})",
    )


def _sums(name: str, entity: str) -> str:
    return f"""SELECT {entity} AS id, sum(rating) AS s, sum(rating * rating) AS ss FROM {name} GROUP BY 1"""


def _near(by: str, measure: str, centred: bool, k: int, self_mode: str = "drop_top") -> dict[str, str]:
    entity, cell = ("user_id", "item_id") if by == "user" else ("item_id", "user_id")
    mine, other = ("users", "items") if by == "user" else ("items", "users")
    dot, sa, sb = "coalesce(x.dot, 0)", "a.ss", "b.ss"
    if centred:
        mu, nu = "(a.s / z.n)", "(b.s / z.n)"
        dot = f"({dot} - {nu} * a.s - {mu} * b.s + z.m * {mu} * {nu})"
        sa = f"greatest(a.ss - 2.0 * {mu} * a.s + z.m * {mu} * {mu}, 0)"
        sb = f"greatest(b.ss - 2.0 * {nu} * b.s + z.m * {nu} * {nu}, 0)"
    sim, norm = dot, f"(sqrt({sa}) * sqrt({sb}))"
    bound = norm
    if measure == "cosine":
        sim, bound = f"CASE WHEN {norm} = 0 THEN 0 ELSE {dot} / {norm} END", "1"
    skip, rank = ("", "rn - 1") if self_mode == "drop_top" else ("WHERE a.id <> b.id", "rn")
    limit = f"rn > 1 AND rn <= {k + 1}" if self_mode == "drop_top" else f"rn <= {k}"
    return {
        "z": f"""SELECT CAST((SELECT count(*) FROM {mine}) AS DOUBLE) AS n, CAST((SELECT count(*) FROM {other}) AS DOUBLE) AS m""",
        "asum": _sums("profiles", entity),
        "bsum": _sums("train", entity),
        "a": f"""SELECT q.id, coalesce(s, 0) AS s, coalesce(ss, 0) AS ss
                 FROM (SELECT DISTINCT {entity} AS id FROM pairs) q LEFT JOIN asum USING (id)""",
        "b": f"SELECT u.id, coalesce(s, 0) AS s, coalesce(ss, 0) AS ss FROM {mine} u LEFT JOIN bsum USING (id)",
        "x": f"""SELECT p.{entity} AS a, t.{entity} AS b, sum(p.rating * t.rating) AS dot
                 FROM profiles p JOIN train t ON p.{cell} = t.{cell} GROUP BY 1, 2""",
        "sims": f"""SELECT a.id AS a, b.id AS b, {sim} AS sim, {bound} AS bound FROM z CROSS JOIN a CROSS JOIN b
                    LEFT JOIN x ON x.a = a.id AND x.b = b.id {skip}""",
        "near": f"""SELECT a, b, sim, CAST({rank} AS INT) AS rank FROM (
                      SELECT *, row_number() OVER (PARTITION BY a ORDER BY
                        CASE WHEN abs(sim) <= 1e-13 * bound THEN 0 ELSE floor(sim * grid + 0.5) / grid END DESC, b DESC) AS rn
                      FROM (SELECT *, power(10, 9 - floor(log10(nullif(abs(sim), 0)))) AS grid FROM sims) s) t WHERE {limit}""",
    }


VIEWS = ["pairs", "train", "profiles", "users", "items"]


def nearest(by: str, measure: str, centred: bool, k: int, self_mode: str = "drop_top") -> str:
    return compose(
        VIEWS, _near(by, measure, centred, k, self_mode), "SELECT a, b, round(sim, 9) + 0.0 AS sim, rank FROM near"
    )


def _joined(by: str, measure: str, centred: bool, k: int) -> dict[str, str]:
    entity, other = ("user_id", "item_id") if by == "user" else ("item_id", "user_id")
    return {
        **_near(by, measure, centred, k),
        "joined": f"""SELECT q.item_id, q.user_id, n.b, n.sim, coalesce(t.rating, 0) AS rating
                      FROM pairs q JOIN near n ON n.a = q.{entity}
                      LEFT JOIN train t ON t.{entity} = n.b AND t.{other} = q.{other}""",
    }


def neighbour_rows(by: str, measure: str, centred: bool, k: int) -> str:
    return compose(
        VIEWS, _joined(by, measure, centred, k),
        "SELECT item_id, user_id, b, round(sim, 9) + 0.0 AS sim, rating + 0.0 AS rating FROM joined",
    )


def _score(mean: str) -> str:
    if mean == "mean":
        return "avg(rating) + 3"
    return "sum(sim * rating) / CASE WHEN sum(sim) = 0 THEN 1 ELSE sum(sim) END + 3"


def _predictions(by: str, measure: str, centred: bool, mean: str, k: int) -> dict[str, str]:
    return {
        **_joined(by, measure, centred, k),
        "pred": f"SELECT item_id, user_id, {_score(mean)} AS score FROM joined GROUP BY 1, 2",
    }


def predicted(by: str, measure: str, centred: bool, mean: str, k: int) -> str:
    return compose(
        VIEWS, _predictions(by, measure, centred, mean, k), "SELECT item_id, user_id, round(score, 6) + 0.0 AS score FROM pred"
    )


def rmse(k: int) -> str:
    return compose(
        [*VIEWS, "truth"], _predictions("user", "dot", False, "mean", k),
        """SELECT round(sqrt(avg(power(truth - score, 2))), 9) AS rmse FROM pred JOIN truth USING (item_id, user_id)""",
    )


def in_order(k: int) -> str:
    return compose(
        [*VIEWS, "targets"], _predictions("user", "dot", False, "mean", k),
        "SELECT pair_idx, item_id, user_id, round(score, 9) + 0.0 AS score FROM targets LEFT JOIN pred USING (item_id, user_id)",
    )


RESCALE = "(score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) * 4 + 1"


def rescaled(k: int) -> str:
    return compose(
        VIEWS, _predictions("item", "dot", False, "mean", k),
        f"SELECT item_id, user_id, round({RESCALE}, 6) AS score FROM pred",
    )


# ---------------------------------------------------------------- factors


def _start(latent: int, scale: float = 1.0) -> str:
    def side(view: str, kind: int) -> str:
        values = ", ".join(
            f"((id * 7919 + {i + kind * latent} * 104729) % 1000) / 1000.0::DOUBLE * {scale} AS f{i}" for i in range(latent)
        )
        return f"SELECT {kind} AS kind, id, {values} FROM {view}"

    return side("users", 0) + " UNION ALL " + side("items", 1)


def _pairs_with_factors(source: str, latent: int, table: str = "f") -> str:
    us = ", ".join(f"u.f{i} AS u{i}" for i in range(latent))
    vs = ", ".join(f"v.f{i} AS v{i}" for i in range(latent))
    dot = " + ".join(f"u.f{i} * v.f{i}" for i in range(latent))
    return f"""SELECT r.*, {us}, {vs}, {dot} AS dot FROM {source} r
               JOIN {table} u ON u.kind = 0 AND u.id = r.user_id JOIN {table} v ON v.kind = 1 AND v.id = r.item_id"""


def _slopes(source: str, latent: int, slope: str) -> str:
    sums = ", ".join(f"sum({slope} * CASE k.kind WHEN 0 THEN v{i} ELSE u{i} END) AS g{i}" for i in range(latent))
    return f"""SELECT k.kind, CASE k.kind WHEN 0 THEN user_id ELSE item_id END AS id, {sums}
               FROM ({_pairs_with_factors(source, latent)}) t, (VALUES (0), (1)) k(kind) GROUP BY 1, 2"""


def _cols(latent: int, prefix: str = "f") -> str:
    return ", ".join(f"{prefix}{i}" for i in range(latent))


def _gradient_steps(latent: int, steps: int) -> dict[str, str]:
    moved = ", ".join(f"f.f{i} + 1e-4 * (coalesce(g.g{i}, 0) + 0.2 * f.f{i})" for i in range(latent))
    return {
        "rated": "SELECT * FROM stars WHERE rating <> 0",
        f"f(it, kind, id, {_cols(latent)})": f"""
          SELECT 0, kind, id, {_cols(latent)} FROM ({_start(latent)}) s
          UNION ALL
          SELECT f.it + 1, f.kind, f.id, {moved} FROM f
          LEFT JOIN ({_slopes("rated", latent, "(rating - dot)")}) g ON g.kind = f.kind AND g.id = f.id
          WHERE f.it < {steps}""",
        "factors": f"SELECT kind, id, {_cols(latent)} FROM f WHERE it = {steps}",
    }


FACTOR_VIEWS = ["stars", "users", "items"]


def _factor_result(latent: int) -> str:
    return "SELECT kind, id, " + ", ".join(f"round(f{i}, 9) + 0.0 AS f{i}" for i in range(latent)) + " FROM factors"


def mf_gradient(latent: int, steps: int) -> str:
    return compose(FACTOR_VIEWS, _gradient_steps(latent, steps), _factor_result(latent))


def mf_gradient_settled(latent: int, step: float, tol: float) -> str:
    """Steps until the relative change of the error falls below ``tol``; a state carries the error before it."""
    moved = ", ".join(f"f.f{i} + {step} * (coalesce(g.g{i}, 0) + 0.2 * f.f{i})" for i in range(latent))
    error = f"SELECT sum(power(rating - dot, 2)) AS sse FROM ({_pairs_with_factors('rated', latent)}) t"
    steps = {
        "rated": "SELECT * FROM stars WHERE rating <> 0",
        f"f(it, kind, id, {_cols(latent)}, last)": f"""
          SELECT 0, kind, id, {_cols(latent)}, CAST(NULL AS DOUBLE) FROM ({_start(latent)}) s
          UNION ALL
          SELECT f.it + 1, f.kind, f.id, {moved}, e.sse FROM f
          LEFT JOIN ({_slopes("rated", latent, "(rating - dot)")}) g ON g.kind = f.kind AND g.id = f.id
          CROSS JOIN ({error}) e
          WHERE f.last IS NULL OR abs(e.sse - f.last) / f.last >= {tol}""",
        "factors": f"SELECT kind, id, {_cols(latent)} FROM f WHERE it = (SELECT max(it) FROM f)",
    }
    return compose(FACTOR_VIEWS, steps, _factor_result(latent))


def mf_sigmoid(latent: int, steps: int) -> str:
    return compose(FACTOR_VIEWS, _sigmoid_steps(latent, steps), _factor_result(latent))


def mf_predict_sigmoid(latent: int, steps: int) -> str:
    return compose(
        [*FACTOR_VIEWS, "pairs"],
        {
            **_sigmoid_steps(latent, steps),
            "pred": f"""SELECT item_id, user_id, 1 / (1 + exp(-dot)) AS score
                FROM ({_pairs_with_factors('pairs', latent, 'factors')}) t""",
        },
        f"SELECT item_id, user_id, round({RESCALE}, 6) + 0.0 AS score FROM pred",
    )


def _sigmoid_steps(latent: int, steps: int) -> dict[str, str]:
    norm = "sqrt(" + " + ".join(f"f.f{i} * f.f{i}" for i in range(latent)) + ")"

    def grad(i: int) -> str:
        pull = f"CASE WHEN {norm} > 0 THEN 0.2 * f.f{i} / {norm} ELSE 0 END"
        return f"(coalesce(g.g{i}, 0) + {pull} + 1e-4 * f.f{i})"

    d = ", ".join(f"{grad(i)} AS d{i}" for i in range(latent))
    ms = ", ".join(f"0.9 * m{i} + 0.1 * d{i} AS m{i}" for i in range(latent))
    ss = ", ".join(f"0.999 * s{i} + 0.001 * d{i} * d{i} AS s{i}" for i in range(latent))
    fs = ", ".join(
        f"f{i} - 0.01 * (m{i} / (1 - power(0.9, it + 1))) / (sqrt(s{i} / (1 - power(0.999, it + 1))) + 1e-8)"
        for i in range(latent)
    )
    keep = ", ".join(f"f.{k}{i}" for k in "fms" for i in range(latent))
    slope = "2 * (1 / (1 + exp(-dot)) - rating) * (1 / (1 + exp(-dot))) * (1 - 1 / (1 + exp(-dot)))"
    zeros = ", ".join(f"CAST(0 AS DOUBLE) AS {k}{i}" for k in "ms" for i in range(latent))
    return {
            "rated": "SELECT user_id, item_id, (rating - 1) / 4.0 AS rating FROM stars WHERE rating <> 1",
            f"f(it, kind, id, {_cols(latent)}, {_cols(latent, 'm')}, {_cols(latent, 's')})": f"""
              SELECT 0, kind, id, {_cols(latent)}, {zeros} FROM ({_start(latent, 0.1)}) s
              UNION ALL
              SELECT it + 1, kind, id, {fs}, {_cols(latent, 'm')}, {_cols(latent, 's')} FROM (
                SELECT it, kind, id, {_cols(latent)}, {ms}, {ss} FROM (
                  SELECT f.it, f.kind, f.id, {keep}, {d} FROM f
                  LEFT JOIN ({_slopes("rated", latent, slope)}) g ON g.kind = f.kind AND g.id = f.id
                  WHERE f.it < {steps}) x) y""",
            "factors": f"SELECT kind, id, {_cols(latent)} FROM f WHERE it = {steps}",
    }


def mf_minibatch(latent: int, batches: int, block: bool = False) -> str:
    decay = "CASE k.kind WHEN 0 THEN 1 - 0.005 * 0.05 ELSE 1 - 0.005 * 0.1 END"
    placed = {
        "numbered": "SELECT *, row_number() OVER (ORDER BY user_id, item_id) AS pos FROM stars",
        "placed": f"""SELECT *, (pos - 1) // CAST(ceil((SELECT count(*) FROM stars) / {batches}.0) AS BIGINT) AS batch
                      FROM numbered""",
        "later": """SELECT user_id, item_id, pos, batch, rating,
                      row_number() OVER (PARTITION BY batch, user_id ORDER BY pos DESC) AS ju,
                      row_number() OVER (PARTITION BY batch, item_id ORDER BY pos DESC) AS jv FROM placed""",
    }
    current = "(SELECT * FROM later WHERE batch = (SELECT max(it) FROM f))"
    pairs = _pairs_with_factors(current, latent)
    j = "CASE k.kind WHEN 0 THEN ju ELSE jv END"
    if block:
        slope = "CASE WHEN rating <> 0 THEN rating - dot ELSE 0 END"
        sums = ", ".join(f"{slope} * CASE k.kind WHEN 0 THEN v{i} ELSE u{i} END AS g{i}" for i in range(latent))
        step = f"""SELECT k.kind, CASE k.kind WHEN 0 THEN user_id ELSE item_id END AS id, 1 AS c, {sums}
                   FROM ({pairs}) t, (VALUES (0), (1)) k(kind) WHERE {j} = 1"""
        rate = "CASE f.kind WHEN 0 THEN 0.05 ELSE 0.1 END"
        moved = [f"f.f{i} + 0.005 * (g.g{i} - {rate} * f.f{i})" for i in range(latent)]
    else:
        sums = ", ".join(
            f"sum(power({decay}, {j} - 1) * 2 * (dot - rating) * CASE k.kind WHEN 0 THEN v{i} ELSE u{i} END) AS g{i}"
            for i in range(latent)
        )
        step = f"""SELECT k.kind, CASE k.kind WHEN 0 THEN user_id ELSE item_id END AS id, count(*) AS c, {sums}
                   FROM ({pairs}) t, (VALUES (0), (1)) k(kind) GROUP BY 1, 2"""
        rate = decay.replace("k.kind", "f.kind")
        moved = [f"power({rate}, g.c) * f.f{i} - 0.005 * g.g{i}" for i in range(latent)]
    chosen = ", ".join(f"CASE WHEN g.c IS NULL THEN f.f{i} ELSE {m} END" for i, m in enumerate(moved))
    return compose(
        FACTOR_VIEWS,
        {
            **placed,
            f"f(it, kind, id, {_cols(latent)})": f"""
              SELECT 0, kind, id, {_cols(latent)} FROM ({_start(latent)}) s
              UNION ALL
              SELECT f.it + 1, f.kind, f.id, {chosen} FROM f
              LEFT JOIN ({step}) g ON g.kind = f.kind AND g.id = f.id WHERE f.it < {batches}""",
            "factors": f"SELECT kind, id, {_cols(latent)} FROM f WHERE it = {batches}",
        },
        _factor_result(latent),
    )


def mf_predict(latent: int, steps: int, rescale: bool) -> str:
    score, digits = (RESCALE, 6) if rescale else ("score", 9)
    return compose(
        [*FACTOR_VIEWS, "pairs"],
        {
            **_gradient_steps(latent, steps),
            "pred": f"SELECT item_id, user_id, dot AS score FROM ({_pairs_with_factors('pairs', latent, 'factors')}) t",
        },
        f"SELECT item_id, user_id, round({score}, {digits}) + 0.0 AS score FROM pred",
    )


def masked_sse(latent: int, steps: int) -> str:
    return compose(
        FACTOR_VIEWS, _gradient_steps(latent, steps),
        f"SELECT round(sum(power(rating - dot, 2)), 4) AS sse FROM ({_pairs_with_factors('rated', latent, 'factors')}) t",
    )
