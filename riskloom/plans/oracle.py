"""DuckDB SQL oracles for the query catalogue.

Each string computes, from the raw driver tables, what the Spark query
returns. The tree oracles grow trees in SQL: per feature, candidate
thresholds are midpoints of neighbouring distinct training values, rows go
left when ``x <= threshold``, a classifier leaf predicts 1 when its positive
share is above one half, a regressor leaf predicts its mean. The stump and
depth-2 trees are written out by hand (lowest weighted gini wins; for the
regressor the sum of squared errors orders splits identically on a 0/1
label). ``_levels_ctes`` grows a tree of any depth level by level with the
learner's own gain formulas and tie order; it serves the depth-5 and
default-parameter queries and the clinical flows, whose rows come from the
same derivations as ``plans/clinical.py``.
"""

from __future__ import annotations

from riskloom.plans.clinical import DIABETES_FORMS, DIABETES_SQL, HEART_FORMS, HEART_SQL
from riskloom.specs import DIABETES, HEART

Q = "CAST(trunc(l_quantity) AS BIGINT)"
RISK = f"CAST(((({Q} * 7 + l_orderkey * 13) % 50) + {Q}) > 40 AS INTEGER)"
SEPARABLE = "CAST(l_quantity > 17 AS INTEGER)"
CODED = (
    "CAST((CAST(floor(l_discount * 100 + 0.5) AS BIGINT) + CAST(floor(l_tax * 100 + 0.5) AS BIGINT) * 2"
    " + l_linenumber + l_orderkey % 4) > 14 AS INTEGER)"
)
FEATURES = ("l_quantity", "l_discount", "l_tax")
CODED_FEATURES = ("l_linenumber", "l_discount", "l_tax")
IS_TRAIN = "substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 4) < 'cccc'"


def _tree_ctes(label: str = RISK) -> str:
    return f"""
base AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
         {label} AS risk, {IS_TRAIN} AS is_train
  FROM lineitem),
long AS (
  SELECT 0 AS f, l_quantity AS v, risk AS y FROM base WHERE is_train
  UNION ALL SELECT 1 AS f, l_discount AS v, risk AS y FROM base WHERE is_train
  UNION ALL SELECT 2 AS f, l_tax AS v, risk AS y FROM base WHERE is_train),
cnt AS (
  SELECT f, v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS p FROM long GROUP BY f, v),
cum AS (
  SELECT f, v,
         lead(v) OVER (PARTITION BY f ORDER BY v) AS nv,
         sum(n) OVER (PARTITION BY f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ln,
         sum(p) OVER (PARTITION BY f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lp,
         sum(n) OVER (PARTITION BY f) AS tn,
         sum(p) OVER (PARTITION BY f) AS tp
  FROM cnt),
cand AS (
  SELECT f, (v + nv) / 2.0 AS thr, ln, lp, tn - ln AS rn, tp - lp AS rp, tn, tp
  FROM cum WHERE nv IS NOT NULL),
scored AS (
  SELECT *,
         ln / tn * (1 - (lp / ln) * (lp / ln) - (1 - lp / ln) * (1 - lp / ln))
       + rn / tn * (1 - (rp / rn) * (rp / rn) - (1 - rp / rn) * (1 - rp / rn)) AS imp
  FROM cand),
best AS (SELECT * FROM scored ORDER BY imp, f, thr LIMIT 1),
leaf AS (
  SELECT f, thr,
         CASE WHEN 2 * lp > ln THEN 1 ELSE 0 END AS lpred,
         CASE WHEN 2 * rp > rn THEN 1 ELSE 0 END AS rpred,
         CASE WHEN 2 * tp > tn THEN 1 ELSE 0 END AS ppred,
         lp / ln AS lmean, rp / rn AS rmean, tp / tn AS pmean
  FROM best),
test AS (
  SELECT *,
         CASE (SELECT f FROM leaf) WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END
           <= (SELECT thr FROM leaf) AS go_left
  FROM base WHERE NOT is_train),
stump AS (
  SELECT *,
         CASE WHEN go_left THEN (SELECT lpred FROM leaf) ELSE (SELECT rpred FROM leaf) END AS prediction,
         CASE WHEN (SELECT lpred = rpred FROM leaf) THEN (SELECT pmean FROM leaf)
              WHEN go_left THEN (SELECT lmean FROM leaf) ELSE (SELECT rmean FROM leaf) END AS share,
         CASE WHEN go_left THEN (SELECT lmean FROM leaf) ELSE (SELECT rmean FROM leaf) END AS leaf_mean
  FROM test),
majority AS (
  SELECT *, (SELECT ppred FROM leaf) AS prediction, (SELECT pmean FROM leaf) AS leaf_mean FROM test)
"""


def _depth2_ctes(label: str = RISK) -> str:
    """Second level of the tree: each child of the root is split again.

    Candidate thresholds stay the root's (global midpoints); within a child a
    candidate is valid when both sides are non-empty, ties go to the first
    feature, then the lowest threshold; a pure child, or one whose best split
    does not lower the impurity, stays a leaf.
    """
    return _tree_ctes(label) + """,
tr AS (
  SELECT *, CASE (SELECT f FROM leaf) WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END
              <= (SELECT thr FROM leaf) AS go_left
  FROM base WHERE is_train),
child_long AS (
  SELECT go_left, 0 AS f, l_quantity AS v, risk AS y FROM tr
  UNION ALL SELECT go_left, 1 AS f, l_discount AS v, risk AS y FROM tr
  UNION ALL SELECT go_left, 2 AS f, l_tax AS v, risk AS y FROM tr),
child_cnt AS (
  SELECT go_left, f, v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS p
  FROM child_long GROUP BY go_left, f, v),
child_tot AS (
  SELECT go_left, CAST(count(*) AS DOUBLE) AS tn, CAST(sum(risk) AS DOUBLE) AS tp FROM tr GROUP BY go_left),
thresholds AS (SELECT f, (v + nv) / 2.0 AS thr FROM cum WHERE nv IS NOT NULL),
child_cand AS (
  SELECT c.go_left, t.f, t.thr, sum(c.n) AS ln, sum(c.p) AS lp
  FROM thresholds t JOIN child_cnt c ON c.f = t.f AND c.v <= t.thr
  GROUP BY c.go_left, t.f, t.thr),
child_scored AS (
  SELECT k.go_left, k.f, k.thr, k.ln, k.lp, s.tn - k.ln AS rn, s.tp - k.lp AS rp, s.tn, s.tp,
         k.ln / s.tn * (1 - (k.lp / k.ln) * (k.lp / k.ln) - (1 - k.lp / k.ln) * (1 - k.lp / k.ln))
       + (s.tn - k.ln) / s.tn * (1 - ((s.tp - k.lp) / (s.tn - k.ln)) * ((s.tp - k.lp) / (s.tn - k.ln))
                                   - (1 - (s.tp - k.lp) / (s.tn - k.ln)) * (1 - (s.tp - k.lp) / (s.tn - k.ln))) AS imp,
         1 - (s.tp / s.tn) * (s.tp / s.tn) - (1 - s.tp / s.tn) * (1 - s.tp / s.tn) AS parent_imp
  FROM child_cand k JOIN child_tot s ON k.go_left = s.go_left
  WHERE k.ln > 0 AND s.tn - k.ln > 0),
child_best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY go_left ORDER BY imp, f, thr) AS rk FROM child_scored) WHERE rk = 1),
child_node AS (
  SELECT s.go_left,
         (b.f IS NOT NULL AND s.tp > 0 AND s.tp < s.tn AND b.imp < b.parent_imp) AS splits,
         b.f, b.thr,
         CASE WHEN 2 * b.lp > b.ln THEN 1 ELSE 0 END AS lpred,
         CASE WHEN 2 * b.rp > b.rn THEN 1 ELSE 0 END AS rpred,
         CASE WHEN 2 * s.tp > s.tn THEN 1 ELSE 0 END AS own_pred,
         b.lp / b.ln AS lmean, b.rp / b.rn AS rmean, s.tp / s.tn AS own_mean
  FROM child_tot s LEFT JOIN child_best b ON s.go_left = b.go_left),
depth2 AS (
  SELECT t.*,
         CASE WHEN NOT n.splits THEN n.own_pred
              WHEN CASE n.f WHEN 0 THEN t.l_quantity WHEN 1 THEN t.l_discount ELSE t.l_tax END <= n.thr
              THEN n.lpred ELSE n.rpred END AS prediction,
         CASE WHEN NOT n.splits THEN n.own_mean
              WHEN CASE n.f WHEN 0 THEN t.l_quantity WHEN 1 THEN t.l_discount ELSE t.l_tax END <= n.thr
              THEN n.lmean ELSE n.rmean END AS leaf_mean
  FROM test t JOIN child_node n ON t.go_left = n.go_left)
"""


def _gini(n: str, p: str) -> str:
    # 1 - f0^2 - f1^2 with class 0 first, as the learner accumulates it
    return f"(1.0 - (({n} - {p}) / {n}) * (({n} - {p}) / {n}) - ({p} / {n}) * ({p} / {n}))"


def _variance(n: str, p: str) -> str:
    # (sum of squares - sum^2 / n) / n; a 0/1 label's sum of squares is its sum
    return f"(({p} - ({p} * {p}) / {n}) / {n})"


def _lineitem_base(label: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
         {label} AS risk, {IS_TRAIN} AS is_train
  FROM lineitem"""


def _levels_ctes(
    depth: int,
    label: str = RISK,
    impurity: str = "gini",
    features: tuple[str, ...] = FEATURES,
    base: str | None = None,
    carry: tuple[str, ...] = ("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"),
    route_all: bool = False,
    route: str | None = None,
    bins: int | None = None,
) -> str:
    """A tree of any depth (gini classifier or variance regressor), grown
    level by level in SQL.

    Rows carry the id of the node they sit in (root 1, children 2i and
    2i+1). At each level, every open node scores all global candidate
    thresholds with the learner's gain (parent impurity minus weighted child
    impurities), keeps the first maximum (lowest feature, then threshold),
    and splits when that gain is positive and the node is not pure. Leaves
    predict their majority class (ties to class 0) or their mean. Sibling
    leaves with equal predictions are merged by the learner, which does not
    change predictions. With ``bins``, a feature of more values is cut at its
    values of rank ceil(j * n / bins) instead of at midpoints.
    """
    imp = {"gini": _gini, "variance": _variance}[impurity]
    cases = " ".join(f"WHEN {i} THEN CAST({c} AS DOUBLE)" for i, c in enumerate(features))
    x = "CASE {f} " + cases + " END"
    fcols = ", ".join(features)
    rcols = ", ".join(f"r.{c}" for c in features)
    distinct = "\n      UNION ".join(
        f"SELECT DISTINCT {i} AS f, CAST({c} AS DOUBLE) AS v FROM base WHERE is_train" for i, c in enumerate(features)
    )

    def unpivot(k: int) -> str:
        return "\n    UNION ALL ".join(
            f"SELECT node, {i} AS f, CAST({c} AS DOUBLE) AS v, risk FROM r{k} WHERE NOT done"
            for i, c in enumerate(features)
        )

    quantiles = "" if bins is None else f"""
ranked AS (
  SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS rk, count(*) OVER (PARTITION BY f) AS n,
         max(v) OVER (PARTITION BY f) AS top
  FROM ({" UNION ALL ".join(f"SELECT {i} AS f, CAST({c} AS DOUBLE) AS v FROM base WHERE is_train" for i, c in enumerate(features))})),
many AS (SELECT f FROM ranked GROUP BY f HAVING count(DISTINCT v) > {bins}),
gthr AS (
  SELECT * FROM midpoints WHERE f NOT IN (SELECT f FROM many)
  UNION ALL
  SELECT DISTINCT f, v AS thr FROM ranked, range(1, {bins}) AS j(j)
  WHERE f IN (SELECT f FROM many) AND rk = (j * n + {bins} - 1) // {bins} AND v < top),"""
    base = base or _lineitem_base(label)
    ccols = ", ".join(carry)
    ecols = ", ".join(f"e.{c}" for c in carry)
    parts = [
        f"""
base AS (
  {base}),
{"midpoints" if bins else "gthr"} AS (
  SELECT f, (v + nv) / 2.0 AS thr FROM (
    SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nv FROM (
      {distinct}))
  WHERE nv IS NOT NULL),{quantiles}
r0 AS (SELECT {fcols}, risk, 1 AS node, false AS done FROM base WHERE is_train),
e0 AS ({route or f"SELECT {ccols}, risk, 1 AS node FROM base WHERE {'true' if route_all else 'NOT is_train'}"})"""
    ]
    for k in range(depth):
        parts.append(
            f"""
cnt{k} AS (
  SELECT node, f, v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(risk) AS DOUBLE) AS p FROM (
    {unpivot(k)})
  GROUP BY node, f, v),
tot{k} AS (
  SELECT node, CAST(count(*) AS DOUBLE) AS tn, CAST(sum(risk) AS DOUBLE) AS tp FROM r{k} WHERE NOT done GROUP BY node),
cand{k} AS (
  SELECT c.node, t.f, t.thr, sum(c.n) AS ln, sum(c.p) AS lp
  FROM gthr t JOIN cnt{k} c ON c.f = t.f AND c.v <= t.thr GROUP BY c.node, t.f, t.thr),
gain{k} AS (
  SELECT c.node, c.f, c.thr,
         {imp("o.tn", "o.tp")}
         - (c.ln / o.tn) * {imp("c.ln", "c.lp")}
         - ((o.tn - c.ln) / o.tn) * {imp("(o.tn - c.ln)", "(o.tp - c.lp)")} AS gain
  FROM cand{k} c JOIN tot{k} o ON c.node = o.node
  WHERE c.ln > 0 AND o.tn - c.ln > 0 AND o.tp > 0 AND o.tp < o.tn),
split{k} AS (
  SELECT node, f, thr FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, thr) AS rk FROM gain{k})
  WHERE rk = 1 AND gain > 0),
r{k + 1} AS (
  SELECT {rcols}, r.risk,
         CASE WHEN s.node IS NULL THEN r.node
              ELSE 2 * r.node + CASE WHEN {x.format(f="s.f")} <= s.thr THEN 0 ELSE 1 END END AS node,
         s.node IS NULL AS done
  FROM r{k} r LEFT JOIN split{k} s ON r.node = s.node AND NOT r.done),
e{k + 1} AS (
  SELECT {ecols}, e.risk,
         CASE WHEN s.node IS NULL THEN e.node
              ELSE 2 * e.node + CASE WHEN {x.format(f="s.f")} <= s.thr THEN 0 ELSE 1 END END AS node
  FROM e{k} e LEFT JOIN split{k} s ON e.node = s.node)"""
        )
    parts.append(
        f"""
leafpred AS (
  SELECT node, CASE WHEN 2 * sum(risk) > count(*) THEN 1 ELSE 0 END AS prediction,
         CAST(sum(risk) AS DOUBLE) / count(*) AS leaf_mean
  FROM r{depth} GROUP BY node),
grown AS (
  SELECT e.*, l.prediction, l.leaf_mean FROM e{depth} e JOIN leafpred l ON e.node = l.node)"""
    )
    return ",".join(parts)


CONTINUOUS_FEATURES = ("l_extendedprice", "l_quantity", "l_discount")


def _continuous_ctes(impurity: str) -> str:
    base = f"""SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount,
         CAST(l_extendedprice + l_orderkey % 7 * 1000 > 38000 AS INTEGER) AS risk, {IS_TRAIN} AS is_train
  FROM lineitem"""
    carry = ("l_orderkey", "l_linenumber", *CONTINUOUS_FEATURES)
    return _levels_ctes(5, impurity=impurity, features=CONTINUOUS_FEATURES, base=base, carry=carry, bins=32)


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


CONFUSION = "SELECT prediction, risk AS label, count(*) AS n FROM {src} GROUP BY prediction, risk"
REG_OUT = "SELECT round(leaf_mean, 6) AS prediction, risk AS label, count(*) AS n FROM {src} GROUP BY 1, 2"

STUMP_METRICS = """
SELECT count(risk) AS n_test, count(*) FILTER (WHERE risk IS NULL) AS n_null_label,
       CAST(sum(CASE WHEN prediction = risk THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       count(*) FILTER (WHERE prediction = 0 AND risk = 0) AS tn,
       count(*) FILTER (WHERE prediction = 1 AND risk = 0) AS fp,
       count(*) FILTER (WHERE prediction = 0 AND risk = 1) AS fn,
       count(*) FILTER (WHERE prediction = 1 AND risk = 1) AS tp,
       round(avg(CASE WHEN prediction = risk THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(ceil(avg(CASE WHEN prediction = risk THEN 1.0 ELSE 0.0 END) * 100) AS BIGINT) AS accuracy_percent
FROM stump
"""


# the verdict rules, spelt out: anything but 0 is diabetic, only 1 is heart disease
DIABETES_VERDICT = """
       CASE WHEN prediction <> 0 THEN 'person is diabetic' ELSE 'person is not diabetic' END AS message,
       CASE WHEN prediction <> 0 THEN '1' ELSE '0' END AS val,
       CASE WHEN prediction <> 0 THEN 'red' ELSE 'green' END AS colour"""
HEART_VERDICT = """
       CASE WHEN prediction = 1 THEN 'person is having heart disease' ELSE 'person is not having heart disease' END AS message,
       CASE WHEN prediction = 1 THEN '1' ELSE '0' END AS val,
       CASE WHEN prediction = 1 THEN 'red' ELSE 'green' END AS colour"""


def _verdict_sql(verdict: str) -> str:
    return f"""
SELECT l_orderkey, l_linenumber, prediction, {verdict}
FROM (SELECT l_orderkey, l_linenumber, CAST(l_linenumber % 3 AS INTEGER) AS prediction FROM lineitem)
"""


def _scored_requests_sql() -> str:
    body = f"""
SELECT l_orderkey, l_linenumber, false AS rejected, prediction, {DIABETES_VERDICT}
FROM all_scored
"""
    ctes = _tree_ctes() + """,
all_scored AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN CASE (SELECT f FROM leaf) WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END
                   <= (SELECT thr FROM leaf)
              THEN (SELECT lpred FROM leaf) ELSE (SELECT rpred FROM leaf) END AS prediction
  FROM base)
"""
    return _with(ctes, body)


def _one_record_sql() -> str:
    """The literal requests through the tree grown from lineitem; on a
    separable label its first split is the whole tree."""
    from riskloom.plans.queries.serving import ONE_RECORDS

    values = ", ".join(f"({rid}, {float(q)}, {float(d)}, {float(t)})" for rid, q, d, t in ONE_RECORDS)
    return _with(
        _tree_ctes(SEPARABLE),
        f"""
SELECT request_id, prediction, {DIABETES_VERDICT}
FROM (SELECT request_id,
             CASE WHEN CASE f WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END <= thr THEN lpred ELSE rpred END AS prediction
      FROM (VALUES {values}) AS r(request_id, l_quantity, l_discount, l_tax), leaf)
""",
    )


def _grown_metrics(regressor: bool = False) -> str:
    p = "CAST(round_even(leaf_mean, 0) AS INTEGER)" if regressor else "prediction"
    return f"""
SELECT count(risk) AS n_test, count(*) FILTER (WHERE risk IS NULL) AS n_null_label,
       CAST(sum(CASE WHEN p = risk THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       count(*) FILTER (WHERE p = 0 AND risk = 0) AS tn,
       count(*) FILTER (WHERE p = 1 AND risk = 0) AS fp,
       count(*) FILTER (WHERE p = 0 AND risk = 1) AS fn,
       count(*) FILTER (WHERE p = 1 AND risk = 1) AS tp,
       round(avg(CASE WHEN p = risk THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(ceil(avg(CASE WHEN p = risk THEN 1.0 ELSE 0.0 END) * 100) AS BIGINT) AS accuracy_percent
FROM (SELECT risk, {p} AS p FROM grown)
"""


def _clinical_sql(spec, base: str, impurity: str = "gini") -> str:
    feats = tuple(spec.features)
    ctes = _levels_ctes(5, impurity=impurity, features=feats, base=base, carry=("o_orderkey", *feats))
    return _with(ctes, _grown_metrics(regressor=impurity == "variance"))


def _clinical_score_sql(spec, base: str, verdict: str) -> str:
    """Every row scored by the spec's default tree, then its verdict."""
    feats = tuple(spec.features)
    ctes = _levels_ctes(5, features=feats, base=base, carry=("o_orderkey", *feats), route_all=True)
    return _with(ctes, f"SELECT o_orderkey, false AS rejected, prediction, {verdict} FROM grown")


SPOILED = " OR ".join(f"o_orderkey % {n} = 0" for n in (11, 13, 17, 19, 23, 29, 31))


def _clinical_rejects_sql(spec, base: str, verdict: str) -> str:
    """The same, but rows with a spoiled value have no prediction and no verdict."""
    return f"""
SELECT o_orderkey, {SPOILED} AS rejected,
       CASE WHEN NOT ({SPOILED}) THEN prediction END AS prediction, CASE WHEN NOT ({SPOILED}) THEN message END AS message,
       CASE WHEN NOT ({SPOILED}) THEN val END AS val, CASE WHEN NOT ({SPOILED}) THEN colour END AS colour
FROM ({_clinical_score_sql(spec, base, verdict)})"""


def _clinical_one_sql(spec, base: str, verdict: str, forms) -> str:
    """Literal form submissions routed through the spec's default tree."""
    feats = tuple(spec.features)
    types = {f.name: f.dataType.simpleString() for f in spec.feature_schema.fields}
    rows = ", ".join(
        "(" + ", ".join([str(rid)] + [f"CAST('{v}' AS {'INTEGER' if types[c] == 'int' else 'DOUBLE'})"
                                      for c, v in zip(feats, vals)]) + ", 0, 1)"
        for rid, vals in forms
    )
    route = f"SELECT * FROM (VALUES {rows}) AS r(request_id, {', '.join(feats)}, risk, node)"
    ctes = _levels_ctes(5, features=feats, base=base, carry=("request_id", *feats), route=route)
    return _with(ctes, f"SELECT CAST(request_id AS INTEGER) AS request_id, prediction, {verdict} FROM grown")


PARSE_REQUESTS = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 17 AS INTEGER) END AS Pregnancies,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_totalprice END AS Glucose,
  CAST(o_custkey % 120 AS DOUBLE) AS BloodPressure,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderkey % 99 AS DOUBLE) END AS SkinThickness,
  CAST(o_custkey % 846 AS DOUBLE) AS Insulin,
  CAST(o_custkey % 500 AS DOUBLE) / CAST(10 AS DOUBLE) AS BMI,
  o_totalprice / CAST(100000 AS DOUBLE) AS DiabetesPedigreeFunction,
  CAST(21 + o_orderkey % 60 AS INTEGER) AS Age,
  (o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 23 = 0) AS rejected
FROM orders
"""

PAIRS = "SELECT prediction, risk AS label FROM stump"


def oracle_sql() -> dict[str, str]:
    t = _tree_ctes()
    sep = _tree_ctes(SEPARABLE)
    scored = _scored_requests_sql()
    return {
        "train_eval_end_to_end": _with(t, STUMP_METRICS),
        "scan_csv_typed": "SELECT * FROM orders",
        "scan_csv_malformed": """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       c_mktsegment, c_custkey % 10 = 0 AS is_malformed
FROM customer""",
        "scan_csv_infer": "SELECT * FROM customer",
        "scan_text_from_csv": "SELECT * FROM customer",
        "table_append_readback": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
        "store_schema_free": """
SELECT *, false AS rejected FROM customer
UNION ALL BY NAME
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS c_name, c_nationkey,
       CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment,
       c_custkey % 10 = 0 AS rejected
FROM customer""",
        "ingest_stream": f"SELECT o_orderkey, {', '.join(DIABETES.features)}, risk AS {DIABETES.label} FROM ({DIABETES_SQL})",
        "cast_project": """
SELECT 'strict' AS mode, o_orderkey, o_totalprice, CAST(o_custkey AS INTEGER) AS o_custkey FROM orders
UNION ALL
SELECT 'tolerant' AS mode, o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS o_totalprice,
       CAST(o_custkey AS INTEGER) AS o_custkey
FROM orders""",
        "sql_view_filter": "SELECT * FROM customer WHERE c_acctbal < 20",
        "assemble_features": """
SELECT 0 AS pos, 'l_quantity' AS feature, round(sum(l_quantity), 4) AS total FROM lineitem
UNION ALL SELECT 1 AS pos, 'l_discount' AS feature, round(sum(l_discount), 4) AS total FROM lineitem
UNION ALL SELECT 2 AS pos, 'l_tax' AS feature, round(sum(l_tax), 4) AS total FROM lineitem""",
        "assemble_skip_invalid": """
SELECT o_orderkey FROM orders
WHERE o_orderkey % 7 <> 0 AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice) AND o_custkey IS NOT NULL""",
        "random_split_invariants": "SELECT count(*) AS total, count(*) AS n_split, true AS same_rows, true AS share_ok FROM orders",
        "hash_split_null_keys": """
SELECT method, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, true AS nulls_together
FROM orders, (VALUES ('md5'), ('xxhash64')) AS m(method) GROUP BY method""",
        "hash_split": "SELECT o_orderkey, substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) < 'cccc' AS is_train FROM orders",
        "dt_classifier_majority": _with(t, CONFUSION.format(src="majority")),
        "dt_classifier_stump": _with(t, CONFUSION.format(src="stump")),
        "dt_classifier_separable": _with(
            sep, "SELECT l_orderkey, l_linenumber, l_quantity, prediction, risk AS label FROM stump"
        ),
        "dt_classifier_depth2": _with(
            _depth2_ctes(),
            "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, prediction, risk AS label FROM depth2",
        ),
        "dt_classifier_depth5": _with(
            _levels_ctes(5),
            "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, prediction, risk AS label FROM grown",
        ),
        "dt_classifier_defaults": _with(
            _levels_ctes(5, CODED, features=CODED_FEATURES),
            "SELECT l_orderkey, l_linenumber, l_discount, l_tax, prediction, risk AS label FROM grown",
        ),
        "dt_regressor_defaults": _with(
            _levels_ctes(5, CODED, impurity="variance", features=CODED_FEATURES), REG_OUT.format(src="grown")
        ),
        "train_eval_diabetes": _clinical_sql(DIABETES, DIABETES_SQL),
        "train_eval_heart": _clinical_sql(HEART, HEART_SQL),
        "train_eval_diabetes_regressor": _clinical_sql(DIABETES, DIABETES_SQL, impurity="variance"),
        "train_eval_heart_regressor": _clinical_sql(HEART, HEART_SQL, impurity="variance"),
        "score_one_diabetes": _clinical_one_sql(DIABETES, DIABETES_SQL, DIABETES_VERDICT, DIABETES_FORMS),
        "score_one_heart": _clinical_one_sql(HEART, HEART_SQL, HEART_VERDICT, HEART_FORMS),
        "score_diabetes": _clinical_score_sql(DIABETES, DIABETES_SQL, DIABETES_VERDICT),
        "score_heart": _clinical_score_sql(HEART, HEART_SQL, HEART_VERDICT),
        "score_routed": f"""
SELECT 'diabetes' AS dataset, * FROM ({_clinical_score_sql(DIABETES, DIABETES_SQL, DIABETES_VERDICT)})
UNION ALL BY NAME SELECT 'heart' AS dataset, * FROM ({_clinical_score_sql(HEART, HEART_SQL, HEART_VERDICT)})
UNION ALL BY NAME SELECT 'unknown' AS dataset, o_orderkey, true AS rejected, CAST(NULL AS INTEGER) AS prediction,
       CAST(NULL AS VARCHAR) AS message, CAST(NULL AS VARCHAR) AS val, CAST(NULL AS VARCHAR) AS colour
FROM orders WHERE o_orderkey % 10 = 0""",
        "score_stream_heart": _clinical_score_sql(HEART, HEART_SQL, HEART_VERDICT),
        "dt_regressor_mean": _with(t, REG_OUT.format(src="majority")),
        "dt_regressor_depth2": _with(_depth2_ctes(), REG_OUT.format(src="depth2")),
        "dt_regressor_depth5": _with(_levels_ctes(5, impurity="variance"), REG_OUT.format(src="grown")),
        "dt_regressor_stump": _with(t, REG_OUT.format(src="stump")),
        "predict_probability": _with(
            t,
            "SELECT prediction, round(1 - share, 6) AS p0, round(share, 6) AS p1, count(*) AS n "
            "FROM stump GROUP BY 1, 2, 3",
        ),
        "model_roundtrip": _with(t, CONFUSION.format(src="stump")),
        "model_roundtrip_regressor": _with(t, REG_OUT.format(src="stump")),
        "round_predictions": """
SELECT l_orderkey, l_linenumber, l_quantity / 2 AS half,
       CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS prediction
FROM lineitem""",
        "prediction_label_pairs": _with(t, PAIRS),
        "accuracy": _with(t, "SELECT round(avg(CASE WHEN prediction = risk THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM stump"),
        "accuracy_percent": _with(
            t,
            "SELECT round(avg(CASE WHEN prediction = risk THEN 1.0 ELSE 0.0 END), 6) AS accuracy, "
            "CAST(ceil(avg(CASE WHEN prediction = risk THEN 1.0 ELSE 0.0 END) * 100) AS BIGINT) AS accuracy_percent "
            "FROM stump",
        ),
        "verdict_default_positive": _verdict_sql(DIABETES_VERDICT),
        "verdict_default_negative": _verdict_sql(HEART_VERDICT),
        "parse_requests": PARSE_REQUESTS,
        "score_one_record": _one_record_sql(),
        "score_batch": scored,
        "score_stream": scored,
        "predictions_csv_roundtrip": _with(t, PAIRS),
        "predictions_json": _with(
            t,
            "SELECT prediction, risk AS label, "
            "CAST(to_json({'prediction': prediction, 'label': risk}) AS VARCHAR) AS json FROM stump",
        ),
        "predictions_json_file": _with(t, PAIRS),
        "display_table": _with(
            t,
            """
SELECT true AS is_header, CAST(NULL AS BIGINT) AS l_orderkey, CAST(NULL AS INTEGER) AS l_linenumber, 'prediction' AS c0, 'label' AS c1
UNION ALL
SELECT false, l_orderkey, l_linenumber, CAST(prediction AS VARCHAR), CAST(risk AS VARCHAR) FROM stump""",
        ),
        "display_counts": _with(
            t,
            """
SELECT true AS is_header, CAST(NULL AS INTEGER) AS prediction, CAST(NULL AS INTEGER) AS label, 'prediction' AS c0, 'label' AS c1, 'n' AS c2
UNION ALL
SELECT false, prediction, risk, CAST(prediction AS VARCHAR), CAST(risk AS VARCHAR), CAST(count(*) AS VARCHAR)
FROM stump GROUP BY prediction, risk""",
        ),
        "train_eval_string_store": _clinical_sql(DIABETES, DIABETES_SQL),
        "train_three_classes": f"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 17 THEN 0 WHEN l_quantity <= 34 THEN 1 ELSE 2 END AS prediction,
       CASE WHEN l_quantity <= 17 THEN 0 WHEN l_quantity <= 34 THEN 1 ELSE 2 END AS label
FROM lineitem WHERE NOT ({IS_TRAIN})""",
        "dt_continuous": _with(_continuous_ctes("gini"), "SELECT l_orderkey, l_linenumber, prediction, risk AS label FROM grown"),
        "dt_continuous_regressor": _with(_continuous_ctes("variance"), REG_OUT.format(src="grown")),
        "accuracy_evaluator": _with(t, "SELECT count(*) AS n_test, round(avg(CASE WHEN prediction = risk THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM stump"),
        "score_batch_rejects": _clinical_rejects_sql(DIABETES, DIABETES_SQL, DIABETES_VERDICT),
    }
