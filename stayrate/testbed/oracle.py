"""The registered queries restated in SQL for DuckDB, over the same tables."""

from __future__ import annotations

from stayrate.operators.metrics import THRESHOLDS
from stayrate.operators.quality import RANGE_COLUMNS
from stayrate.schemas import CATEGORICAL_COLUMNS, NOISE_FACTOR, NUMERIC_COLUMNS, SERVICE_COLUMNS, SUBSCRIBER_TYPES
from stayrate.testbed.tables import SNAPSHOT

COLUMNS = ", ".join(SUBSCRIBER_TYPES)


def half_up(expression: str, places: int) -> str:
    """Round a double by its shortest decimal text, halves away from zero, as Spark does."""
    return f"CAST(CAST(CAST(CAST({expression} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,{places})) AS DOUBLE)"


def dbl(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def _internet(condition: str) -> str:
    return f"CASE WHEN p2 = 0 THEN 'No internet service' WHEN {condition} THEN 'Yes' ELSE 'No' END"


def _yes(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Yes' ELSE 'No' END"


_ORDER_PROFILE = f"""
profile AS (
  SELECT o_custkey,
         count(*) FILTER (WHERE past) AS n,
         count(*) FILTER (WHERE past AND o_orderpriority = '1-URGENT') AS p1,
         count(*) FILTER (WHERE past AND o_orderpriority = '2-HIGH') AS p2,
         count(*) FILTER (WHERE past AND o_orderpriority = '3-MEDIUM') AS p3,
         count(*) FILTER (WHERE past AND o_orderpriority = '4-NOT SPECIFIED') AS p4,
         count(*) FILTER (WHERE past AND o_orderpriority = '5-LOW') AS p5,
         count(*) FILTER (WHERE past AND o_orderstatus = 'P') AS s_p,
         count(*) FILTER (WHERE past AND o_orderstatus = 'F') AS s_f,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE past) AS tot,
         count(*) FILTER (WHERE NOT past) AS n_after
  FROM (SELECT *, o_orderdate < TIMESTAMP '{SNAPSHOT}' AS past FROM orders)
  GROUP BY o_custkey
)"""

_SUBSCRIBERS = f"""{_ORDER_PROFILE},
keyed AS (
  SELECT c_name AS customerID,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS SeniorCitizen,
         {_yes('s_f >= 3')} AS Partner,
         {_yes('s_f >= 5')} AS Dependents,
         c_custkey % 73 AS tenure,
         {_yes('p1 >= 1')} AS PhoneService,
         CASE WHEN p1 = 0 THEN 'No phone service' WHEN p1 >= 3 THEN 'Yes' ELSE 'No' END AS MultipleLines,
         CASE WHEN p2 = 0 THEN 'No' WHEN p2 >= 3 THEN 'Fiber optic' ELSE 'DSL' END AS InternetService,
         {_internet('p3 >= 2')} AS OnlineSecurity,
         {_internet('p3 >= 3')} AS OnlineBackup,
         {_internet('p4 >= 2')} AS DeviceProtection,
         {_internet('p4 >= 3')} AS TechSupport,
         {_internet('p5 >= 2')} AS StreamingTV,
         {_internet('p5 >= 3')} AS StreamingMovies,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'One year' WHEN 'MACHINERY' THEN 'Two year'
              ELSE 'Month-to-month' END AS Contract,
         {_yes('s_p >= 3')} AS PaperlessBilling,
         CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
              WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
         CAST(tot AS DOUBLE) / n AS MonthlyCharges,
         CAST(tot AS DOUBLE) AS TotalCharges,
         CAST(CASE WHEN n_after = 0 THEN 1 ELSE 0 END AS BIGINT) AS Churn,
         CAST(tot AS VARCHAR) AS _total,
         c_custkey AS _k
  FROM customer JOIN profile ON c_custkey = o_custkey
  WHERE n > 0
),
subscribers AS (SELECT {COLUMNS} FROM keyed)"""

_RAW = f"""{_SUBSCRIBERS},
raw AS (
  SELECT * REPLACE (
    CASE _k % 7 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN ' ' || _total || ' ' WHEN 3 THEN 'NaN'
         WHEN 4 THEN 'abc' ELSE _total END AS TotalCharges,
    CASE WHEN _k % 11 = 0 THEN 'maybe' WHEN Churn = 1 THEN 'Yes' ELSE 'No' END AS Churn)
  FROM keyed
)"""

_CLEAN_TOTAL = """coalesce(CASE WHEN isnan(TRY_CAST(trim(TotalCharges) AS DOUBLE)) THEN NULL
         ELSE TRY_CAST(trim(TotalCharges) AS DOUBLE) END, CAST(0 AS DOUBLE))"""
_CLEAN_CHURN = "CAST(CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS BIGINT)"

_GAPPY = f"""{_SUBSCRIBERS},
gappy AS (
  SELECT {COLUMNS} FROM (
    SELECT * REPLACE (
      CASE WHEN _k % 17 = 0 THEN NULL WHEN _k % 23 = 0 THEN -tenure - 1 ELSE tenure END AS tenure,
      CASE WHEN _k % 29 = 0 THEN -MonthlyCharges ELSE MonthlyCharges END AS MonthlyCharges,
      CASE WHEN _k % 19 <> 0 THEN TechSupport END AS TechSupport,
      CASE WHEN _k % 13 <> 0 THEN Contract END AS Contract,
      CASE WHEN _k % 31 <> 0 THEN Churn END AS Churn)
    FROM keyed)
)"""

_PLANTED = """
scored AS (
  SELECT customerID, CAST(CASE WHEN u < p THEN 1 ELSE 0 END AS DOUBLE) AS label,
         (p + v) / CAST(2 AS DOUBLE) AS score,
         CAST(floor((p + v) * 10) AS DOUBLE) / CAST(20 AS DOUBLE) AS score_coarse
  FROM (
    SELECT c_name AS customerID,
           CAST(CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 0.08
                     WHEN c_custkey % 73 < 24 THEN 0.55 ELSE 0.25 END AS DOUBLE) AS p,
           CAST((c_custkey * 1103515245 + 12345) % 2147483648 AS DOUBLE) / CAST(2147483648 AS DOUBLE) AS u,
           CAST((c_custkey * 22695477 + 1) % 2147483648 AS DOUBLE) / CAST(2147483648 AS DOUBLE) AS v
    FROM customer)
)"""

_STACKED = f"""{_PLANTED},
stacked AS (
  SELECT model, label, CAST(CASE WHEN score >= {dbl(0.5)} THEN 1 ELSE 0 END AS DOUBLE) AS prediction, score
  FROM (SELECT 'LR' AS model, label, score_coarse AS score FROM scored
        UNION ALL SELECT 'RF', label, score FROM scored
        UNION ALL SELECT 'GBT', label, score FROM scored)
)"""

_BUCKET = """CASE WHEN tenure BETWEEN 0 AND 12 THEN 'new' WHEN tenure BETWEEN 13 AND 24 THEN 'growing'
         WHEN tenure BETWEEN 25 AND 48 THEN 'mature' ELSE 'loyal' END"""
_PER_MONTH = "TotalCharges / CASE WHEN tenure = 0 THEN 1 ELSE tenure END"
_COMPLAINT = "CASE WHEN TechSupport = 'No' AND OnlineSecurity = 'No' THEN 1 ELSE 0 END"
_SERVICES = " + ".join(f"CASE WHEN {c} IN ('Yes', '1') THEN 1 ELSE 0 END" for c in SERVICE_COLUMNS)


def _averages(source: str) -> str:
    return f"""SELECT Contract, {half_up('avg(MonthlyCharges)', 2)} AS avg_charge_by_contract
    FROM {source} GROUP BY Contract"""


def _engineered(source: str) -> str:
    return f"""
engineered AS (
  SELECT s.*, {_BUCKET} AS tenure_bucket, avg_charge_by_contract,
         {half_up(f'MonthlyCharges / (avg_charge_by_contract + {dbl(1e-9)})', 4)} AS charge_ratio,
         {half_up(_PER_MONTH, 2)} AS charge_per_month,
         CAST({_COMPLAINT} AS INTEGER) AS complaint_proxy,
         CAST({_SERVICES} AS INTEGER) AS service_count
  FROM {source} s JOIN ({_averages(source)}) a ON s.Contract = a.Contract
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _digest(purpose: str, key: str) -> str:
    return f"md5('{purpose}:42:' || CAST({key} AS VARCHAR))"


def _hash(purpose: str, key: str) -> str:
    return f"CAST('0x' || substr({_digest(purpose, key)}, 1, 15) AS BIGINT)"


def _normal(purpose: str, key: str) -> str:
    radius, angle = (
        f"((CAST('0x' || substr({_digest(purpose, key)}, {start}, 13) AS BIGINT) + {dbl(0.5)}) / {dbl(float(2**52))})"
        for start in (1, 17)
    )
    return f"sqrt({dbl(-2.0)} * ln({radius})) * cos({dbl(2.0)} * pi() * {angle})"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _sweep(source: str) -> str:
    steps = ", ".join(dbl(t) for t in THRESHOLDS)
    return f"""
cells AS (
  SELECT model, threshold,
         count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
         count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
         count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn,
         count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
         count(*) AS n
  FROM {source}, (SELECT unnest([{steps}]) AS threshold)
  GROUP BY model, threshold
),
rates AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp / (tp + fn) END AS recall
  FROM cells
),
sweep AS (
  SELECT model, threshold, precision, recall,
         CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE
              ELSE 2 * precision * recall / (precision + recall) END AS f1,
         (tp + tn) / n AS accuracy, tp, fp, fn, tn
  FROM rates
)"""


_MATRIX = f"""{_STACKED},
matrix AS (
  SELECT model, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
  FROM stacked GROUP BY model
),
rates AS (
  SELECT *, tn / (tn + fn) AS precision_0, tn / (tn + fp) AS recall_0,
         CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp / (tp + fp) END AS precision_1,
         tp / (tp + fn) AS recall_1
  FROM matrix
),
graded AS (
  SELECT *, 2 * precision_0 * recall_0 / (precision_0 + recall_0) AS f1_0,
         CASE WHEN precision_1 + recall_1 = 0 THEN 0.0::DOUBLE
              ELSE 2 * precision_1 * recall_1 / (precision_1 + recall_1) END AS f1_1
  FROM rates
)"""


def _ranked(source: str) -> str:
    return f"""
totals AS (
  SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM {source} GROUP BY model, score
),
ranked AS (
  SELECT model, score, pos, neg,
         CAST(sum(pos) OVER down AS BIGINT) AS tp, CAST(sum(neg) OVER down AS BIGINT) AS fp,
         CAST(sum(pos) OVER whole AS BIGINT) AS p, CAST(sum(neg) OVER whole AS BIGINT) AS n
  FROM totals
  WINDOW down AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING), whole AS (PARTITION BY model)
)"""


_ONE = "one AS (SELECT 'M' AS model, label, score FROM scored)"
_COARSE = "one AS (SELECT 'M' AS model, label, score_coarse AS score FROM scored)"
_ROC_POINTS = """SELECT score, tp, fp, tp / p AS tpr, fp / n AS fpr FROM ranked
UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0, 0.0::DOUBLE, 0.0::DOUBLE
UNION ALL SELECT CAST('-inf' AS DOUBLE), max(p), max(n), 1.0::DOUBLE, 1.0::DOUBLE FROM ranked"""
_AUC = """SELECT model, max(p) AS positives, max(n) AS negatives,
       CAST(sum(neg * (2 * (tp - pos) + pos)) AS DOUBLE) / (CAST(2 AS DOUBLE) * max(p) * max(n)) AS roc_auc
FROM ranked GROUP BY model"""

_INDEXED = f"""{_GAPPY},
bucketed AS (SELECT *, {_BUCKET} AS tenure_bucket FROM gappy),
pairs AS (
  SELECT customerID, "column", value FROM bucketed
  UNPIVOT INCLUDE NULLS (value FOR "column" IN ({', '.join(CATEGORICAL_COLUMNS)}))
),
counted AS (SELECT "column", value, count(*) AS "count" FROM pairs WHERE value IS NOT NULL GROUP BY ALL),
indexed AS (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value) - 1 AS position,
         count(*) OVER (PARTITION BY "column") AS width
  FROM counted
)"""

# Indices are learned from rows that have a contract, as the encoder sees the engineered table.
_VECTORS = f"""{_GAPPY}, {_engineered('gappy')},
pairs AS (
  SELECT customerID, "column", value FROM engineered
  UNPIVOT (value FOR "column" IN ({', '.join(CATEGORICAL_COLUMNS)}))
),
counted AS (SELECT "column", value, count(*) AS n FROM pairs GROUP BY ALL),
indexed AS (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) - 1 AS position FROM counted
),
widths AS (
  SELECT "column", list_position([{', '.join(f"'{c}'" for c in CATEGORICAL_COLUMNS)}], "column") AS place,
         count(*) AS width
  FROM indexed GROUP BY "column"
),
starts AS (
  SELECT "column", {len(NUMERIC_COLUMNS)} + coalesce(sum(width) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM widths
),
complete AS (SELECT * FROM engineered WHERE tenure IS NOT NULL),
slots AS (
  SELECT customerID, start + position AS slot, CAST(1 AS DOUBLE) AS value
  FROM pairs JOIN indexed USING ("column", value) JOIN starts USING ("column")
  UNION ALL
  {_union([f'SELECT customerID, {i}, CAST({c} AS DOUBLE) FROM complete' for i, c in enumerate(NUMERIC_COLUMNS)])}
)"""

_NULLS = _union([f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM gappy" for c in SUBSCRIBER_TYPES])
_RANGES = _union(
    [
        f'SELECT \'{c}\' AS "column", CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM gappy'
        for c in ("tenure", "MonthlyCharges", "TotalCharges")
    ]
)
_NEGATIVES = _union(
    [
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < 0) AS negatives FROM gappy"
        for c in ("tenure", "MonthlyCharges")
    ]
)
_STDDEVS = _union(
    [
        f"SELECT '{c}' AS \"column\", {half_up(f'stddev_samp({c})', 4)} AS stddev FROM subscribers"
        for c in ("tenure", "MonthlyCharges", "TotalCharges")
    ]
)
_REPORT = f"""
nulls AS ({_NULLS}), negatives AS ({_NEGATIVES})
SELECT 'row_count' AS "check", '*' AS "column", CAST(count(*) AS DOUBLE) AS value, count(*) = 2000000 AS ok FROM gappy
UNION ALL SELECT 'null_count', "column", CAST(nulls AS DOUBLE), nulls = 0 FROM nulls
UNION ALL SELECT 'negative_count', "column", CAST(negatives AS DOUBLE), negatives = 0 FROM negatives
""" + "".join(
    f"UNION ALL SELECT '{bound}', '{c}', CAST({bound}({c}) AS DOUBLE), NULL FROM gappy\n" for c in RANGE_COLUMNS for bound in ("min", "max")
) + f"""UNION ALL SELECT 'class_count', 'Churn=' || coalesce(CAST(Churn AS VARCHAR), 'NULL'), CAST(count(*) AS DOUBLE), NULL FROM gappy GROUP BY Churn
UNION ALL SELECT 'class_pct', 'Churn=' || coalesce(CAST(Churn AS VARCHAR), 'NULL'),
       {half_up('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM gappy) * 100', 2)}, NULL FROM gappy GROUP BY Churn"""


def _noise(source: str, key: str) -> str:
    """The noisy columns of ``source``, which carries its own columns and the seed table's spread."""

    def moved(column: str) -> str:
        value = f"{column} + {_normal(f'noise-{column}', key)} * ({dbl(NOISE_FACTOR)} * {column}_sd)"
        return f"CASE WHEN {value} < 0 THEN CAST(0 AS DOUBLE) ELSE {value} END"

    return f"""CAST(round_even({moved('tenure')}, 0) AS BIGINT) AS tenure,
       {half_up(moved('MonthlyCharges'), 4)} AS MonthlyCharges,
       {half_up(moved('TotalCharges'), 4)} AS TotalCharges
FROM {source}, (SELECT stddev_samp(tenure) AS tenure_sd, stddev_samp(MonthlyCharges) AS MonthlyCharges_sd,
                       stddev_samp(TotalCharges) AS TotalCharges_sd FROM subscribers)"""


def _subscriber_id(value: str, chunk: int) -> str:
    return f"printf('CUST-%04d-%06d', {value} // {chunk}, {value} % {chunk})"


_DRAWN = f"""{_SUBSCRIBERS},
numbered AS (SELECT *, row_number() OVER (ORDER BY customerID) - 1 AS source_row FROM subscribers),
draws AS (
  SELECT row_id, {_hash('draw', 'row_id')} % (SELECT count(*) FROM subscribers) AS source_row
  FROM (SELECT unnest(range(0, (SELECT 4 * count(*) FROM subscribers))) AS row_id)
),
drawn AS (SELECT * FROM draws JOIN numbered USING (source_row))"""


def _label_order(column: str, table: str = "lineitem") -> str:
    """Labels of a column, the most frequent first, ties by name."""
    return f"""{column}_order AS (
  SELECT value, row_number() OVER (ORDER BY n DESC, value) - 1 AS place
  FROM (SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n FROM {table} GROUP BY 1)
)"""


def _label_joins(names: dict[str, str]) -> str:
    return " ".join(f"JOIN {c}_order {a} ON {a}.value = CAST(l.{c} AS VARCHAR)" for a, c in names.items())


_ROUTED = f"""{_RAW},
routed AS (
  SELECT customerID, CASE WHEN right(customerID, 1) = '8' THEN 'missing' WHEN Churn IN ('Yes', 'No') THEN 'used'
         ELSE 'quarantined' END AS label_status,
         CAST(CASE WHEN right(customerID, 1) <> '8' THEN CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END END AS DOUBLE) AS label
  FROM raw
)"""

ORACLE: dict[str, str] = {
    "parquet_scan": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "multi_file_scan": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "row_bounded_write": "SELECT count(*) AS row_count, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM lineitem",
    "csv_scan": _with(_RAW, f"SELECT {COLUMNS} FROM (SELECT * REPLACE ({_CLEAN_TOTAL} AS TotalCharges, {_CLEAN_CHURN} AS Churn) FROM raw)"),
    "score_csv_round_trip": _with(_PLANTED, "SELECT customerID, label, score_coarse AS churn_probability FROM scored"),
    "coerce_numeric": _with(_RAW, f"SELECT customerID, {_CLEAN_TOTAL} AS TotalCharges FROM raw"),
    "map_yes_no": _with(_RAW, f"SELECT customerID, {_CLEAN_CHURN} AS Churn FROM raw"),
    "label_resolved": _with(_RAW, f"SELECT customerID, CAST({_CLEAN_CHURN} AS DOUBLE) AS label FROM raw"),
    "binarize_label": _with(_RAW, "SELECT customerID, CAST(CASE WHEN Churn IN ('Yes', '1') THEN 1 ELSE 0 END AS DOUBLE) AS label FROM raw"),
    "tenure_bucket": _with(_GAPPY, f"SELECT *, {_BUCKET} AS tenure_bucket FROM gappy"),
    "charge_per_month": _with(
        _SUBSCRIBERS,
        f"SELECT customerID, {_PER_MONTH} AS raw_value, {half_up(_PER_MONTH, 2)} AS charge_per_month FROM subscribers",
    ),
    "complaint_proxy": _with(_GAPPY, f"SELECT customerID, CAST({_COMPLAINT} AS INTEGER) AS complaint_proxy FROM gappy"),
    "service_count": _with(_GAPPY, f"SELECT customerID, CAST({_SERVICES} AS INTEGER) AS service_count FROM gappy"),
    "clip_lower": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS clipped FROM customer",
    "round_half_even": "SELECT o_orderkey, CAST(round_even(CAST(o_custkey AS DOUBLE) / 2, 0) AS BIGINT) AS rounded FROM orders",
    "format_ids": f"SELECT {_subscriber_id('l_orderkey', 1000)} AS small_chunks, {_subscriber_id('l_orderkey', 500000)} AS customerID FROM lineitem",
    "threshold_predicate": _with(
        _PLANTED, f"SELECT customerID, CAST(CASE WHEN score_coarse >= {dbl(0.3)} THEN 1 ELSE 0 END AS INTEGER) AS flagged FROM scored"
    ),
    "drop_column": _with(
        _SUBSCRIBERS, "SELECT * EXCLUDE (Churn), CAST(Churn AS DOUBLE) AS label FROM subscribers"
    ),
    "contract_avg_charge": _with(_SUBSCRIBERS, _averages("subscribers")),
    "contract_avg_join": _with(
        f"{_GAPPY}, {_engineered('gappy')}", "SELECT customerID, Contract, avg_charge_by_contract FROM engineered"
    ),
    "charge_ratio": _with(f"{_SUBSCRIBERS}, {_engineered('subscribers')}", "SELECT customerID, charge_ratio FROM engineered"),
    "feature_table": _with(f"{_SUBSCRIBERS}, {_engineered('subscribers')}", "SELECT * FROM engineered"),
    "feature_table_with_gaps": _with(f"{_GAPPY}, {_engineered('gappy')}", "SELECT * FROM engineered"),
    "row_count": _with(_SUBSCRIBERS, "SELECT count(*) AS row_count FROM subscribers"),
    "null_counts": _with(_GAPPY, _NULLS),
    "range_profile": _with(_GAPPY, _RANGES),
    "negative_counts": _with(_GAPPY, _NEGATIVES),
    "class_distribution": _with(
        _GAPPY,
        f'SELECT Churn, count(*) AS "count", {half_up("count(*) / sum(count(*)) OVER () * 100", 2)} AS pct '
        "FROM gappy GROUP BY Churn ORDER BY Churn NULLS FIRST",
    ),
    "stddev_profile": _with(_SUBSCRIBERS, _STDDEVS),
    "quality_report": _with(f"{_GAPPY},", _REPORT),
    "confusion_matrix": _with(_MATRIX, "SELECT * FROM matrix"),
    "class_metrics": _with(_MATRIX, "SELECT * FROM graded"),
    "accuracy": _with(_MATRIX, "SELECT model, (tp + tn) / (tn + fp + fn + tp) AS accuracy FROM graded"),
    "weighted_f1": _with(
        _MATRIX, f"SELECT model, {half_up('((tn + fp) * f1_0 + (fn + tp) * f1_1) / (tn + fp + fn + tp)', 6)} AS weighted_f1 FROM graded"
    ),
    "threshold_sweep": _with(f"{_PLANTED}, {_COARSE}, {_sweep('one')}", "SELECT * EXCLUDE (model) FROM sweep"),
    "best_threshold": _with(
        f"{_STACKED}, {_sweep('stacked')}",
        "SELECT * FROM sweep QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) = 1",
    ),
    "roc_points": _with(f"{_PLANTED}, {_ONE}, {_ranked('one')}", _ROC_POINTS),
    "roc_points_tied": _with(f"{_PLANTED}, {_COARSE}, {_ranked('one')}", _ROC_POINTS),
    "roc_auc": _with(f"{_STACKED}, {_ranked('stacked')}", _AUC),
    "pr_points": _with(
        f"{_PLANTED}, {_COARSE}, {_ranked('one')}",
        "SELECT score, tp / p AS recall, tp / (tp + fp) AS precision FROM ranked "
        "UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0::DOUBLE, 1.0::DOUBLE",
    ),
    "pr_area": _with(
        f"""{_PLANTED}, {_ONE}, {_ranked('one')},
points AS (
  SELECT score, pos, p, tp / (tp + fp) AS precision,
         coalesce(lag(tp / (tp + fp)) OVER (ORDER BY score DESC), CAST(1 AS DOUBLE)) AS previous FROM ranked
)""",
        f"SELECT {half_up('sum(pos / p * (precision + previous) / 2)', 6)} AS pr_auc_trapezoid, "
        f"{half_up('sum(pos / p * precision)', 6)} AS average_precision FROM points",
    ),
    "best_model": _with(
        f"{_STACKED}, {_ranked('stacked')}, areas AS ({_AUC})",
        "SELECT model, roc_auc AS auc FROM areas ORDER BY roc_auc DESC, list_position(['LR', 'RF', 'GBT'], model) LIMIT 1",
    ),
    "ranked_scores": _with(f"{_PLANTED}, {_ONE}, {_ranked('one')}", "SELECT score, tp, fp FROM ranked"),
    "hash_sample": f"SELECT o_orderkey, o_custkey FROM orders WHERE {_hash('sample', 'o_orderkey')} < {int(0.1 * 2**60)}",
    "hash_split": _with(
        _SUBSCRIBERS,
        f"SELECT customerID, {_hash('split', 'customerID')} < {int(0.8 * 2**60)} AS is_train, "
        f"CAST({_hash('fold', 'customerID')} % 3 AS INTEGER) AS fold FROM subscribers",
    ),
    "bootstrap_rows": _with(
        _DRAWN,
        f"SELECT {_subscriber_id('row_id', 500000)} AS customerID, customerID AS source_id, row_id, source_row, "
        "tenure, MonthlyCharges, Contract FROM drawn",
    ),
    "gaussian_noise": _with(_SUBSCRIBERS, f"SELECT customerID, {_noise('subscribers', 'customerID')}"),
    "scaled_up_subscribers": _with(
        _DRAWN,
        f"SELECT {_subscriber_id('row_id', 500000)} AS customerID, Contract, Churn, row_id, source_row, {_noise('drawn', 'row_id')}",
    ),
    "string_index": _with(
        _INDEXED, 'SELECT "column", value, "count", CAST(position AS DOUBLE) AS "index" FROM indexed'
    ),
    "one_hot": _with(
        f'{_INDEXED}, widths AS (SELECT DISTINCT "column", width FROM indexed)',
        """SELECT customerID, "column", CASE WHEN position IS NULL THEN repeat('0', widths.width)
       ELSE repeat('0', position) || '1' || repeat('0', widths.width - 1 - position) END AS bits
FROM pairs LEFT JOIN indexed USING ("column", value) JOIN widths USING ("column")""",
    ),
    "assembled_features": _with(
        _VECTORS,
        "SELECT customerID, CAST(Churn AS DOUBLE) AS label, CAST(slot AS INTEGER) AS slot, "
        "slots.value FROM slots JOIN complete USING (customerID) WHERE slots.value <> 0",
    ),
    "footer_profile": _with(
        _GAPPY,
        "SELECT count(*) AS rows, "
        + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in SUBSCRIBER_TYPES)
        + ", "
        + ", ".join(f"CAST(min({c}) AS DOUBLE) AS min_{c}, CAST(max({c}) AS DOUBLE) AS max_{c}" for c in RANGE_COLUMNS)
        + ", count(*) FILTER (WHERE tenure < 0) AS negative_tenure, count(*) FILTER (WHERE MonthlyCharges < 0) AS \"negative_MonthlyCharges\" FROM gappy",
    ),
    "stored_order_ranges": (
        "SELECT count(*) AS rows, "
        + ", ".join(f"count({c}) AS filled_{c}" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
        + ", min(o_orderkey) AS min_o_orderkey, min(o_custkey) AS min_o_custkey, max(o_orderkey) AS max_o_orderkey, "
        "max(o_custkey) AS max_o_custkey FROM orders"
    ),
    "file_skew_checks": "SELECT CAST(6 AS BIGINT) AS files, count(*) AS rows, true AS fits FROM orders",
    "routed_labels": _with(_ROUTED, "SELECT customerID, label, label_status FROM routed"),
    "routed_label_counts": _with(
        _ROUTED,
        "SELECT count(*) AS row_count, count(*) FILTER (WHERE label = 0) AS label_0, count(*) FILTER (WHERE label = 1) AS label_1, "
        + ", ".join(f"count(*) FILTER (WHERE label_status = '{s}') AS {s}" for s in ("used", "missing", "quarantined"))
        + " FROM routed",
    ),
    "wide_string_index": _with(
        ", ".join(_label_order(c) for c in ("l_orderkey", "l_partkey", "l_returnflag")),
        "SELECT l.l_orderkey, l.l_partkey, l.l_returnflag, any_value(a.place) AS l_orderkey_index, any_value(b.place) AS l_partkey_index, "
        "any_value(c.place) AS l_returnflag_index, count(*) AS n FROM lineitem l "
        + _label_joins({"a": "l_orderkey", "b": "l_partkey", "c": "l_returnflag"})
        + " GROUP BY 1, 2, 3",
    ),
    "wide_features": _with(
        ", ".join(_label_order(c) for c in ("l_orderkey", "l_partkey")),
        "SELECT l_orderkey, l_linenumber, unnest(CASE WHEN l_quantity <> 0 THEN [0] ELSE [] END || [1 + a.place, "
        "1 + (SELECT count(*) FROM l_orderkey_order) + b.place]) AS slot FROM lineitem l "
        + _label_joins({"a": "l_orderkey", "b": "l_partkey"}),
    ),
    "written_validation": _with(
        f"{_GAPPY}, {_engineered('gappy')}",
        "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS null_features, CAST(0 AS BIGINT) AS null_labels, "
        "count(*) FILTER (WHERE Churn = 0) AS label_0, count(*) FILTER (WHERE Churn = 1) AS label_1, "
        "count(Churn) AS used, count(*) - count(Churn) AS missing, CAST(0 AS BIGINT) AS quarantined, "
        "(SELECT count(*) FROM gappy) AS rows_read, (SELECT count(*) FROM gappy WHERE Contract IS NULL) AS skipped_contract, "
        "(SELECT count(*) FROM gappy WHERE Contract IS NOT NULL) - count(*) AS skipped_number "
        "FROM engineered WHERE tenure IS NOT NULL",
    ),
    "score_projection": _with(
        _PLANTED,
        f"SELECT customerID, CAST(CASE WHEN score >= {dbl(0.5)} THEN 1 ELSE 0 END AS DOUBLE) AS prediction, "
        "score AS churn_probability, label FROM scored",
    ),
    "prediction_projection": _with(
        _PLANTED,
        f"SELECT label, CAST(CASE WHEN score >= {dbl(0.5)} THEN 1 ELSE 0 END AS DOUBLE) AS prediction, "
        "score AS probability FROM scored",
    ),
}

# Held-out rows of the planted subscribers: those that the hash puts on the other side.
_TRAIN = f"{_hash('split', 'customerID')} < {int(0.8 * 2**60)}"
_HELD = f"""{_SUBSCRIBERS}, {_PLANTED.lstrip()},
known AS (SELECT subscribers.* EXCLUDE (Churn), label FROM subscribers JOIN scored USING (customerID)),
held AS (SELECT * FROM known WHERE NOT ({_TRAIN}))"""
_PER_MODEL = "SELECT model, count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives"
_MODELS = "(SELECT unnest(['LR', 'RF', 'GBT']) AS model)"
_NUMBERS = ", ".join(f"'{c}'" for c in NUMERIC_COLUMNS)
_CATEGORIES = ", ".join(f"'{c}'" for c in CATEGORICAL_COLUMNS)
_NAMED = f"""{_HELD},
bucketed AS (SELECT *, {_BUCKET} AS tenure_bucket FROM known WHERE {_TRAIN}),
pairs AS (SELECT "column", value FROM bucketed UNPIVOT (value FOR "column" IN ({', '.join(CATEGORICAL_COLUMNS)}))),
counted AS (SELECT "column", value, count(*) AS n FROM pairs GROUP BY ALL),
named AS (
  SELECT row_number() OVER (ORDER BY list_position([{_CATEGORIES}], "column"), n DESC, value) + {len(NUMERIC_COLUMNS)} - 1 AS slot,
         "column" || '_ohe_' || value AS feature
  FROM counted
  UNION ALL SELECT generate_subscripts([{_NUMBERS}], 1) - 1, unnest([{_NUMBERS}])
)"""

ORACLE |= {
    "score_checks": _with(_HELD, f"SELECT model, customerID, label, true AS in_range, true AS consistent FROM held, {_MODELS}"),
    "batch_predict_checks": _with(_HELD, "SELECT customerID, label, true AS in_range, true AS consistent FROM known"),
    "vector_input_checks": _with(_HELD, "SELECT customerID, label, true AS in_range, true AS consistent FROM held"),
    "bernoulli_sample_checks": "SELECT count(*) AS orders, CAST(1 AS BIGINT) AS most_copies, true AS size_fits FROM orders",
    "random_split_checks": "SELECT o_orderkey, CAST(1 AS BIGINT) AS sides FROM orders",
    "partition_profile_checks": 'SELECT count(*) AS "rows", true AS consistent FROM lineitem',
    "cv_checks": _with(
        _HELD,
        f"SELECT model, CAST(4 AS BIGINT) AS points, CAST(1 AS BIGINT) AS best, true AS is_maximum, true AS differ, "
        f"count(*) AS train_rows, CAST(3 AS BIGINT) AS folds FROM known, {_MODELS} WHERE {_TRAIN} GROUP BY model",
    ),
    "lr_score_equations": _with(_NAMED, "SELECT CAST(slot AS INTEGER) AS slot, feature, CAST(0 AS DOUBLE) AS mean_residual FROM named"),
    "model_quality_checks": _with(_HELD, f"{_PER_MODEL}, true AS above_floor FROM held, {_MODELS} GROUP BY model"),
    "top_features_checks": _with(_NAMED, "SELECT row_number() OVER () AS place, true AS known FROM named QUALIFY place <= 5"),
    "refused_inputs": _with(
        _SUBSCRIBERS,
        "SELECT input, count(*) AS table_rows, refused_with FROM subscribers, (VALUES ('missing table', 'FileNotFoundError'), "
        "('no label column', 'ValueError'), ('no numeric column', 'ValueError'), ('no split column', 'ValueError'), "
        "('missing model', 'FileNotFoundError'), ('unknown score format', 'ValueError')) AS t(input, refused_with) GROUP BY ALL",
    ),
    "model_comparison_checks": _with(_HELD, f"{_PER_MODEL}, true AS in_range FROM held, {_MODELS} GROUP BY model"),
    "evaluation_summary_checks": _with(_HELD, f"{_PER_MODEL}, true AS named FROM held, {_MODELS} GROUP BY model"),
    "feature_importance_checks": _with(_NAMED, "SELECT CAST(slot AS INTEGER) AS slot, feature, true AS shares FROM named"),
    "binned_auc_checks": "SELECT unnest(['probability', 'rawPrediction']) AS ranked_by, true AS close, CAST(2 AS BIGINT) AS ways",
    "label_accounts": _with(
        _SUBSCRIBERS,
        "SELECT count(*) FILTER (WHERE right(customerID, 1) NOT IN ('7', '8')) AS used, "
        "count(*) FILTER (WHERE right(customerID, 1) = '8') AS missing, "
        "count(*) FILTER (WHERE right(customerID, 1) = '7') AS quarantined FROM subscribers",
    ),
    "order_mean_join": "SELECT l_orderkey, l_linenumber, avg(l_quantity) OVER (PARTITION BY l_orderkey) AS mean_quantity FROM lineitem",
    "schema_issues": _with(
        _SUBSCRIBERS,
        "SELECT issue, \"column\", count(*) AS affected_rows FROM subscribers, "
        "(VALUES ('missing', 'gender'), ('mistyped', 'tenure'), ('unexpected', 'added')) AS t(issue, \"column\") GROUP BY ALL",
    ),
    "numeric_columns": _with(
        _SUBSCRIBERS,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS \"values\" FROM subscribers"
            for c in ("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "Churn")
        ),
    ),
    "positive_probability": _with(_PLANTED, "SELECT customerID, score AS churn_probability FROM scored"),
    "score_parquet_round_trip": _with(_PLANTED, "SELECT customerID, label, score AS churn_probability FROM scored"),
    "model_round_trip": "SELECT CAST(0 AS BIGINT) AS differing",
}
