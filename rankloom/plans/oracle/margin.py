"""DuckDB SQL for margins, SVM solvers and softmax regression."""

from __future__ import annotations

from rankloom.plans.oracle.views import compose
from rankloom.plans.oracle.words import HOLDOUT_STEPS, doc_term_steps

LAM, RATE = 100.0, 0.001
GIVEN = {"w": "SELECT DISTINCT idx, ((idx * 7919) % 1000) / 1000.0::DOUBLE * 20 - 10 AS w FROM feat"}
SCORED = {**GIVEN, "scored": "SELECT row_id, any_value(y) AS y, sum(val * w) AS margin FROM feat JOIN w USING (idx) GROUP BY 1"}
MARGINS = compose(["feat"], SCORED, "SELECT row_id, y, round(margin, 9) + 0.0 AS margin FROM scored")
ACTIVE = compose(["feat"], SCORED, "SELECT row_id FROM scored WHERE 1 - y * margin > 0")
GRADIENT_STEP = {
    **SCORED,
    "g": f"""SELECT w.idx, w.w + 2 * {LAM} / (SELECT count(*) FROM scored) * coalesce(p.s, 0) AS grad FROM w LEFT JOIN
               (SELECT idx, sum(val * (margin - s.y)) AS s FROM feat JOIN scored s USING (row_id)
                WHERE 1 - s.y * margin > 0 GROUP BY 1) p USING (idx)""",
}
GRADIENT = compose(["feat"], GRADIENT_STEP, "SELECT CAST(idx AS INT) AS idx, round(grad, 6) + 0.0 AS grad FROM g")
HINGE_SUM = "sum(power(greatest(0, 1 - y * margin), 2)) / count(*)"
HINGE = compose(["feat"], SCORED, f"SELECT round({HINGE_SUM}, 9) AS loss FROM scored")
OBJECTIVE = compose(
    ["feat"], SCORED,
    f"""SELECT round({HINGE_SUM}, 6) AS loss, round((SELECT sum(w * w) / 2 FROM w) + {LAM} * {HINGE_SUM}, 6) AS objective
        FROM scored""",
)
SIGN_ACCURACY = compose(
    ["feat"], SCORED, "SELECT round(avg(CASE WHEN (margin > 0) = (y = 1) THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM scored"
)


def batches(size: int) -> str:
    return compose(
        ["dense_rows"],
        {"p": "SELECT row_id, row_number() OVER (ORDER BY md5('0:' || row_id), row_id) AS pos, count(*) OVER () AS n FROM dense_rows"},
        f"""SELECT row_id, CAST((pos - 1) // {size} AS INT) AS batch FROM p
            UNION ALL SELECT row_id, CAST((pos - 1) // {size} + 1 AS INT) FROM p
            WHERE n % {size} <> 0 AND (pos - 1) // {size} = n // {size}""",
    )


TRAIN = {
    "ft": "SELECT row_id, y, idx, val FROM feat WHERE NOT is_test",
    "rows": "SELECT DISTINCT row_id, y FROM ft",
    "n": "SELECT CAST(count(*) AS DOUBLE) AS n FROM rows",
}


def _hessian(name: str, vector: str, column: str, source: str) -> dict[str, str]:
    """``v + 2 lam / n * X'Xv`` as the table ``name(idx, hv)``."""
    return {
        f"{name}_dot": f"SELECT row_id, sum(val * {column}) AS dot FROM {source} JOIN {vector} USING (idx) GROUP BY 1",
        name: f"""SELECT v.idx, v.{column} + 2 * {LAM} / n.n * coalesce(h.s, 0) AS hv FROM {vector} v CROSS JOIN n
                  LEFT JOIN (SELECT idx, sum(val * dot) AS s FROM {source} JOIN {name}_dot USING (row_id) GROUP BY 1) h
                  USING (idx)""",
    }


def _conjugate(prefix: str, gradient: str, source: str, iterations: int) -> dict[str, str]:
    """Unrolled conjugate gradient; the last table is ``<prefix>_<iterations>(idx, d, r, p)``."""
    steps = {f"{prefix}_s": f"SELECT idx, ((idx * 7919) % 1000) / 1000.0::DOUBLE AS d FROM {gradient}"}
    steps |= _hessian(f"{prefix}_h", f"{prefix}_s", "d", source)
    steps[f"{prefix}_0"] = f"""SELECT idx, d, -grad - hv AS r, -grad - hv AS p
        FROM {prefix}_s JOIN {prefix}_h USING (idx) JOIN {gradient} USING (idx)"""
    for i in range(iterations):
        now = f"{prefix}_{i}"
        steps |= _hessian(f"{now}h", now, "p", source)
        steps[f"{now}a"] = f"SELECT sum(r * r) / sum(p * hv) AS a, sum(r * r) AS rr FROM {now} JOIN {now}h USING (idx)"
        steps[f"{now}m"] = f"""SELECT idx, d + a * p AS d, r - a * hv AS r, p, rr
            FROM {now} JOIN {now}h USING (idx) CROSS JOIN {now}a"""
        steps[f"{prefix}_{i + 1}"] = f"SELECT idx, d, r, r + sum(r * r) OVER () / rr * p AS p FROM {now}m"
    return steps


CG = compose(
    ["feat"],
    {**GRADIENT_STEP, "n": "SELECT CAST(count(*) AS DOUBLE) AS n FROM scored", **_conjugate("c", "g", "feat", 3)},
    "SELECT CAST(idx AS INT) AS idx, round(d, 6) + 0.0 AS d FROM c_3",
)


def settled_cg(tol: float, most: int) -> str:
    """Conjugate gradient to its stop rule; every row has the number of iterations."""
    steps = {
        **GRADIENT_STEP,
        "n": "SELECT CAST(count(*) AS DOUBLE) AS n FROM scored",
        "c_s": "SELECT idx, ((idx * 7919) % 1000) / 1000.0::DOUBLE AS d FROM g",
        **_hessian("c_h", "c_s", "d", "feat"),
        "c(it, idx, d, r, p, rr)": f"""
          SELECT 0, idx, d, -grad - hv, -grad - hv, sum(power(grad + hv, 2)) OVER ()
          FROM c_s JOIN c_h USING (idx) JOIN g USING (idx)
          UNION ALL
          SELECT it, idx, d, r, r + after / rr * p, after FROM (
            SELECT it, idx, d, r, p, rr, sum(r * r) OVER () AS after FROM (
              SELECT it + 1 AS it, idx, d + rr / curve * p AS d, r - rr / curve * hv AS r, p, rr FROM (
                SELECT c.*, c.p + 2 * {LAM} / n.n * coalesce(h.s, 0) AS hv,
                       sum(c.p * (c.p + 2 * {LAM} / n.n * coalesce(h.s, 0))) OVER () AS curve
                FROM c CROSS JOIN n LEFT JOIN (
                  SELECT f.idx, sum(f.val * o.dot) AS s FROM feat f JOIN (
                    SELECT row_id, sum(val * p) AS dot FROM feat JOIN c USING (idx) GROUP BY 1) o USING (row_id)
                  GROUP BY 1) h USING (idx)
                WHERE c.it < {most} AND (c.it = 0 OR sqrt(c.rr) >= {tol})) t1) t2) t3""",
    }
    return compose(
        ["feat"], steps,
        "SELECT CAST(idx AS INT) AS idx, round(d, 6) + 0.0 AS d, it AS iterations FROM c WHERE it = (SELECT max(it) FROM c)",
    )


def newton(epochs: int, iterations: int) -> str:
    return compose(
        ["feat"], _newton_steps(epochs, iterations), f"SELECT CAST(idx AS INT) AS idx, round(w, 6) + 0.0 AS w FROM w{epochs}"
    )


def _newton_steps(epochs: int, iterations: int) -> dict[str, str]:
    steps = {**TRAIN, "w0": "SELECT DISTINCT idx, CAST(0 AS DOUBLE) AS w FROM ft"}
    for e in range(epochs):
        steps[f"m{e}"] = f"SELECT row_id, any_value(y) AS y, sum(val * w) AS m FROM ft JOIN w{e} USING (idx) GROUP BY 1"
        steps[f"g{e}"] = f"""SELECT w.idx, w.w + 2 * {LAM} / n.n * coalesce(p.s, 0) AS grad FROM w{e} w CROSS JOIN n LEFT JOIN
            (SELECT idx, sum(val * (m - ft.y)) AS s FROM ft JOIN m{e} USING (row_id) WHERE 1 - ft.y * m > 0 GROUP BY 1) p
            USING (idx)"""
        steps |= _conjugate(f"c{e}", f"g{e}", "ft", iterations)
        steps[f"w{e + 1}"] = f"SELECT idx, w + d AS w FROM w{e} JOIN c{e}_{iterations} USING (idx)"
    return steps


def _descent(batch: int, steps: str, epoch: str) -> dict[str, str]:
    """Loop over ``rowsteps(step, row_id)``; ``steps`` is their number."""
    return {
        "w(it, idx, w)": f"""
          SELECT 0, idx, CAST(0 AS DOUBLE) FROM (SELECT DISTINCT idx FROM ft) t
          UNION ALL
          SELECT w.it + 1, w.idx, w.w - {RATE} / (1 + {RATE} / 100 * ({epoch})) * (w.w / {batch} + 2 * {LAM} / n.n * coalesce(g.s, 0))
          FROM w CROSS JOIN n LEFT JOIN (
            SELECT f.idx, sum(f.val * (m.m - m.y)) AS s FROM ft f JOIN (
              SELECT row_id, any_value(ft.y) AS y, sum(ft.val * w.w) AS m FROM ft JOIN w USING (idx)
              WHERE row_id IN (SELECT row_id FROM rowsteps WHERE step = (SELECT max(it) FROM w))
              GROUP BY row_id) m USING (row_id)
            WHERE 1 - m.y * m.m > 0 GROUP BY f.idx) g USING (idx)
          WHERE w.it < {steps}""",
    }


FINAL_WEIGHTS = "SELECT CAST(idx AS INT) AS idx, round(w, 6) + 0.0 AS w FROM w WHERE it = (SELECT max(it) FROM w)"


def pegasos(epochs: int, batch_size: int) -> str:
    return compose(
        ["feat"],
        {
            **TRAIN,
            **_pegasos_rows(epochs, batch_size),
            **_descent(batch_size, str(epochs), "w.it"),
        },
        FINAL_WEIGHTS,
    )


def _pegasos_rows(epochs: int, batch_size: int) -> dict[str, str]:
    return {
        "spots": "SELECT row_id, row_number() OVER (ORDER BY md5('0:' || row_id), row_id) AS pos, count(*) OVER () AS k FROM rows",
        "rowsteps": f"""SELECT step, row_id FROM (
            SELECT step, row_id, pos, k, CAST('0x' || substr(md5('0:' || step), 1, 8) AS BIGINT) % k AS start
            FROM spots CROSS JOIN (SELECT unnest(range({epochs})) AS step) s) t
            WHERE pos > start AND pos <= start + {batch_size} OR pos <= start + {batch_size} - k""",
    }


def _sgd_rows(epochs: int, batch_size: int, block_batches: int) -> dict[str, str]:
    return {
        "size": "SELECT count(*) AS k FROM rows",
        "nb": f"SELECT k // {batch_size} + CASE WHEN k % {batch_size} <> 0 THEN 2 ELSE 1 END AS nb FROM size",
        "dealt": f"""SELECT row_id, (row_number() OVER (ORDER BY md5('0:' || row_id), row_id) - 1) // {batch_size * block_batches} AS blk
                     FROM rows""",
        "placed": f"""SELECT e, row_id, (row_number() OVER (
                          PARTITION BY e ORDER BY blk = k // {batch_size * block_batches}, md5('0:' || e || ':block' || blk), blk,
                          md5('0:' || e || ':' || row_id), row_id) - 1) // {batch_size} AS b
                      FROM dealt CROSS JOIN size CROSS JOIN (SELECT unnest(range({epochs})) AS e) s""",
        "rowsteps": f"""SELECT e * nb + b AS step, row_id FROM placed CROSS JOIN nb
            UNION ALL SELECT e * nb + b + 1, row_id FROM placed CROSS JOIN nb CROSS JOIN size
            WHERE k % {batch_size} <> 0 AND b = k // {batch_size}""",
    }


TEST_ROWS = {"fe": "SELECT row_id, y, idx, val FROM feat WHERE is_test"}


def _measured(method: str, states: str, epochs: str) -> dict[str, str]:
    """Trace rows from ``states(e, idx, w)`` after each epoch and ``epochs(e, grad_norm, loss, scale)``."""
    return {
        **TEST_ROWS,
        "states": states,
        "epochs": epochs,
        "norms": "SELECT e, sum(w * w) AS ww FROM states GROUP BY e",
        "hits": """SELECT e, avg(CASE WHEN (m > 0) = (y = 1) THEN 1.0 ELSE 0.0 END) AS acc FROM (
            SELECT e, row_id, any_value(y) AS y, sum(val * w) AS m FROM fe JOIN states USING (idx) GROUP BY e, row_id) t GROUP BY e""",
        "trace": f"""SELECT '{method}' AS method, CAST(e AS INT) AS iter, grad_norm, loss,
            ww / 2 + {LAM} * loss * scale AS objective, CAST(NULL AS DOUBLE) AS rel, acc
            FROM epochs JOIN norms USING (e) JOIN hits USING (e)""",
    }


_TRACE_ROWS = """SELECT method, iter, round(grad_norm, 5) AS grad_norm, round(loss, 6) AS loss, round(objective, 5) AS objective,
    rel, round(acc, 9) AS acc FROM trace"""
_STEP_LOSS = """SELECT step, sum(power(greatest(0, 1 - y * m), 2)) / any_value(n.n) AS loss FROM (
    SELECT r.step, r.row_id, any_value(ft.y) AS y, sum(ft.val * w.w) AS m FROM rowsteps r JOIN ft USING (row_id)
    JOIN w ON w.idx = ft.idx AND w.it = r.step + 1 GROUP BY r.step, r.row_id) t CROSS JOIN n GROUP BY step"""


def _step_norms(epoch: str) -> str:
    return f"""SELECT a.it AS step, sqrt(sum(power((a.w - b.w) * (1 + {RATE} / 100 * ({epoch})) / {RATE}, 2))) AS norm
        FROM w a JOIN w b ON b.idx = a.idx AND b.it = a.it + 1 GROUP BY a.it"""


def pegasos_trace(epochs: int, batch_size: int) -> str:
    steps = {
        **TRAIN, **_pegasos_rows(epochs, batch_size), **_descent(batch_size, str(epochs), "w.it"),
        "losses": _STEP_LOSS, "moves": _step_norms("a.it"),
        **_measured(
            "pegasos", "SELECT it - 1 AS e, idx, w FROM w WHERE it > 0",
            f"""SELECT step AS e, norm * n.n / {batch_size} AS grad_norm, loss, n.n / {batch_size} AS scale
                FROM moves JOIN losses USING (step) CROSS JOIN n""",
        ),
    }
    return compose(["feat"], steps, _TRACE_ROWS)


def sgd_trace(epochs: int, batch_size: int, block_batches: int) -> str:
    per = "(SELECT nb FROM nb)"
    steps = {
        **TRAIN, **_sgd_rows(epochs, batch_size, block_batches), **_descent(batch_size, f"{epochs} * {per}", f"w.it // {per}"),
        "losses": _STEP_LOSS, "moves": _step_norms(f"a.it // {per}"),
        **_measured(
            "sgd", f"SELECT it // {per} - 1 AS e, idx, w FROM w WHERE it > 0 AND it % {per} = 0",
            f"""SELECT step // {per} AS e, sum(norm) AS grad_norm, sum(coalesce(loss, 0)) AS loss, 1.0 AS scale
                FROM moves LEFT JOIN losses USING (step) GROUP BY 1""",
        ),
    }
    return compose(["feat"], steps, _TRACE_ROWS)


def newton_trace(epochs: int, iterations: int) -> str:
    return compose(["feat"], _newton_trace(epochs, iterations), _TRACE_ROWS)


def best_epoch(epochs: int, iterations: int) -> str:
    return compose(
        ["feat"], _newton_trace(epochs, iterations),
        "SELECT iter, round(loss, 6) AS loss FROM trace ORDER BY trace.loss, iter LIMIT 1",
    )


def _newton_trace(epochs: int, iterations: int) -> dict[str, str]:
    states = " UNION ALL ".join(f"SELECT {e} AS e, idx, w FROM w{e + 1}" for e in range(epochs))
    norms = " UNION ALL ".join(f"SELECT {e} AS e, sqrt(sum(grad * grad)) AS grad_norm FROM g{e}" for e in range(epochs))
    return {
        **_newton_steps(epochs, iterations),
        "norms_g": norms,
        "after": states,
        "losses": """SELECT e, sum(power(greatest(0, 1 - y * m), 2)) / any_value(n.n) AS loss FROM (
            SELECT e, row_id, any_value(y) AS y, sum(val * w) AS m FROM ft JOIN after USING (idx) GROUP BY e, row_id) t
            CROSS JOIN n GROUP BY e""",
        **_measured("newton", "SELECT * FROM after", "SELECT e, grad_norm, loss, 1.0 AS scale FROM norms_g JOIN losses USING (e)"),
    }


def sgd(epochs: int, batch_size: int, block_batches: int) -> str:
    return compose(
        ["feat"],
        {
            **TRAIN,
            **_sgd_rows(epochs, batch_size, block_batches),
            **_descent(batch_size, f"{epochs} * (SELECT nb FROM nb)", "w.it // (SELECT nb FROM nb)"),
        },
        FINAL_WEIGHTS,
    )


CLASSES = range(1, 6)


def _chances(rows: str, weights: str) -> str:
    """Class probabilities of ``rows(row_id, cls)``."""
    sums = ", ".join(f"sum(val * w{c}) AS s{c}" for c in CLASSES)
    exps = ", ".join(f"exp(coalesce(s{c}, 0)) AS x{c}" for c in CLASSES)
    norm = " + ".join(f"x{c}" for c in CLASSES)
    chances = ", ".join(f"x{c} / ({norm}) AS p{c}" for c in CLASSES)
    return f"""SELECT row_id, cls, {chances} FROM (
                 SELECT r.row_id, r.cls, {exps} FROM {rows} r LEFT JOIN
                   (SELECT row_id, {sums} FROM doc_term JOIN {weights} USING (idx) GROUP BY 1) s USING (row_id)) t"""


def softmax(result: str, scheme: str = "DF") -> str:
    ws = ", ".join(f"w{c}" for c in CLASSES)
    pulls = ", ".join(f"sum(f.val * (CASE WHEN r.cls = {c} THEN 1 ELSE 0 END - r.p{c})) AS g{c}" for c in CLASSES)
    moved = ", ".join(f"w.w{c} + 0.0025 / (1 + 0.0025 / 1000 * w.it) * coalesce(g.g{c}, 0)" for c in CLASSES)
    batch = "(SELECT row_id, cls FROM placed_rows WHERE batch = (SELECT max(it) FROM w))"
    steps = {
        **doc_term_steps(scheme),
        "lab": "SELECT doc_id AS row_id, stars AS cls, split FROM reviews",
        "placed_rows": """SELECT row_id, cls, (row_number() OVER (ORDER BY md5('0:' || row_id), row_id) - 1) // 256 AS batch
                          FROM lab WHERE split = 'train'""",
        **HOLDOUT_STEPS,
        "held": """SELECT doc_id AS row_id, stars AS cls FROM placed
                   WHERE pos <= (SELECT round_even(count(*) * 0.3, 0) FROM placed)""",
        "train_terms": "SELECT * FROM doc_term WHERE split = 'train'",
        f"w(it, idx, {ws})": f"""
          SELECT 0, idx, {", ".join(["CAST(0 AS DOUBLE)"] * 5)} FROM (SELECT DISTINCT idx FROM train_terms) t
          UNION ALL
          SELECT w.it + 1, w.idx, {moved} FROM w LEFT JOIN (
            SELECT f.idx, {pulls} FROM train_terms f JOIN ({_chances(batch, "w")}) r USING (row_id) GROUP BY 1) g USING (idx)
          WHERE w.it < (SELECT round_even(count(*) / 256.0, 0) FROM placed_rows)""",
        "model": f"SELECT idx, {ws} FROM w WHERE it = (SELECT max(it) FROM w)",
        "dev": "SELECT row_id, cls FROM lab WHERE split = 'dev'",
        "test": "SELECT row_id, cls FROM lab WHERE split = 'test'",
    }
    best = "greatest(" + ", ".join(f"p{c}" for c in CLASSES) + ")"
    hard = "CASE " + " ".join(f"WHEN p{c} = {best} THEN {c}" for c in CLASSES) + " END"
    soft = " + ".join(f"{c} * p{c}" for c in CLASSES)
    truth = "CASE cls " + " ".join(f"WHEN {c} THEN p{c}" for c in CLASSES) + " END"
    dev = f"({_chances('dev', 'model')}) t"
    size = " + ".join(f"w{c} * w{c}" for c in CLASSES)
    finals = {
        "weights": "SELECT idx, " + ", ".join(f"round(w{c}, 9) + 0.0 AS w{c}" for c in CLASSES) + " FROM model",
        "predict": f"SELECT row_id, CAST({hard} AS INT) AS hard, round({soft}, 6) AS soft FROM {dev}",
        "argmax": f"SELECT row_id, CAST({hard} AS INT) AS hard FROM ({_chances('test', 'model')}) t",
        "accuracy": f"SELECT round(avg(CASE WHEN {hard} = cls THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM {dev}",
        "rmse": f"SELECT round(sqrt(avg(power(cls - ({soft}), 2))), 6) AS rmse FROM {dev}",
        "entropy": f"SELECT round(sum(-ln({truth})) / count(*), 9) AS cross_entropy FROM {dev}",
        "loglik": f"""SELECT round(sum(ln({truth})) - 0.01 / 2 * (SELECT sum({size}) FROM model), 6) AS loglik
                      FROM ({_chances('held', 'model')}) t""",
    }
    return compose(["review_words", "reviews"], steps, finals[result])
