"""One DuckDB statement per registered query."""

from __future__ import annotations

from . import base
from .base import select_shown, with_tables

ID = [("i", "SK_ID_CURR")]
STATEMENTS = {}


def add(name: str, body: str, **extra: str) -> None:
    STATEMENTS[name] = with_tables(body, **extra)


add("status_map", f"SELECT SK_ID_BUREAU, STATUS, CAST({base._STATUS_NUM} AS BIGINT) AS STATUS_NUM FROM bureau_balance")
add("bureau_balance_rollup", select_shown([("i", "SK_ID_BUREAU"), *base.BALANCE], "balance_by_loan"))
add("bureau_features", select_shown(ID + base.BUREAU, "bureau_features"))
add("previous_features", select_shown(ID + base.PREVIOUS, "previous_features"))
add("installment_features", select_shown(ID + base.INSTALLMENTS, "installment_features"))
add("credit_card_features", select_shown(ID + base.CARDS, "credit_card_features"))
add("pos_features", select_shown(ID + base.POS, "pos_features"))
add("application_features", select_shown(base.APPLICATION + base.APPLICATION_ADDED, "application_features"))
add("assembled_dataset", select_shown(base.ASSEMBLED, "assembled"))
add("cleaned_dataset", select_shown(base.ASSEMBLED, "cleaned"))
add("cleaned_by_jobs", select_shown(base.ASSEMBLED, "cleaned"))


# --- train and test at once ------------------------------------------------------------------

_TEST_APPLICATION = base.BOUND["application"].replace("FROM customer", "FROM (SELECT s_suppkey AS c_custkey, s_acctbal AS "
    "c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment, s_nationkey AS c_nationkey FROM supplier) test_rows")
_BOTH = ("SELECT *, 'train' AS dataset FROM application UNION ALL "
         f"SELECT * REPLACE (CAST(NULL AS INT) AS TARGET), 'test' AS dataset FROM ({_TEST_APPLICATION}) t")
_BUILT = base.FEATURES["assembled"].replace("application_features", "both_features")
BOTH = {"both_rows": _BOTH,
        "both_features": base.FEATURES["application_features"].replace("FROM application", "FROM both_rows"),
        "both_built": _BUILT,
        "both_cleaned": base.FEATURES["cleaned"].replace("FROM assembled", ", dataset FROM both_built"),
        "both_stored_raw": select_shown(base.ASSEMBLED + [("s", "dataset")], "both_built"),
        "both_stored": select_shown(base.ASSEMBLED + [("s", "dataset")], "both_cleaned")}
DATASET = [("s", "dataset")]
add("train_test_dataset", select_shown(base.ASSEMBLED + DATASET, "both_built"), **BOTH)


# --- scans and sinks ----------------------------------------------------------------------------

add("scan_normalize_missing", f"""SELECT event_id,
    CASE WHEN {base.K} % 6 = 2 THEN 'XNA' WHEN {base.K} % 6 = 5 THEN event_type END AS kind,
    CASE WHEN {base.K} % 7 <> 0 THEN {base.single('value')} END AS value FROM events""")
add("csv_round_trip", select_shown(ID + base.INSTALLMENTS, "installment_features"))
add("csv_sources_dataset", select_shown(base.ASSEMBLED + DATASET, "both_built"), **BOTH)
add("first_rows", select_shown(base.APPLICATION, "(SELECT * FROM application ORDER BY SK_ID_CURR LIMIT 5) firsts"))


# --- reports --------------------------------------------------------------------------------------

NUMERIC = [n for k, n, *_ in base.ASSEMBLED if k in "id"]
NAMES = [n for _, n, *_ in base.ASSEMBLED]


def cells(columns, source: str, keep: str = "", nulls: bool = True) -> str:
    """(keep, feature, value) of the columns as doubles."""
    listed = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in columns)
    named = ", ".join(f'"{c}"' for c in columns)
    kept = f"{keep}, " if keep else ""
    return (f"SELECT {kept}feature, value FROM (SELECT {kept}{listed} FROM {source}) wide "
            f"UNPIVOT {'INCLUDE NULLS ' if nulls else ''}(value FOR feature IN ({named}))")


def texts(columns, source: str) -> str:
    """(feature, value) of all columns as texts, NULL kept."""
    listed = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
    named = ", ".join(f'"{c}"' for c in columns)
    return (f"SELECT feature, value FROM (SELECT {listed} FROM {source}) wide "
            f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({named}))")


def point(values: str, p: float) -> str:
    """Linearly interpolated quantile of a sorted list without NULLs."""
    at = f"((len({values}) - 1) * {p}::DOUBLE)"
    low, high = f"{values}[CAST(floor({at}) AS INT) + 1]", f"{values}[CAST(ceil({at}) AS INT) + 1]"
    t = f"({at} - floor({at}))"
    return f"CASE WHEN {t} < 0.5 THEN {low} + ({high} - {low}) * {t} ELSE {high} - ({high} - {low}) * (1 - {t}) END"


ALL_TEXT = {"all_text": texts(NAMES, "stored_raw")}
add("table_info", f"""SELECT (SELECT count(*) FROM assembled) AS row_count, CAST({len(NAMES) - 1} AS BIGINT) AS feature_count,
    count(*) FILTER (WHERE value IS NULL) AS missing_cells FROM all_text""", **ALL_TEXT)
_KINDS = {"i": "bigint", "d": "double", "s": "string"}
_LISTED = ", ".join(f"('{n}', {i}, '{_KINDS[k]}')" for i, (k, n, *_) in enumerate(base.ASSEMBLED))
add("column_info", f"""SELECT CAST(ordinal AS BIGINT) AS ordinal, feature, dtype, count(value) AS non_null FROM all_text
    JOIN (VALUES {_LISTED}) l(feature, ordinal, dtype) USING (feature) GROUP BY feature, ordinal, dtype""", **ALL_TEXT)
# fixed values: the application columns in the order of the raw file, which the job's lists keep
_RAW_ORDER = ["SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "NAME_INCOME_TYPE", "DAYS_BIRTH", "DAYS_EMPLOYED",
              "ORGANIZATION_TYPE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
_JOB_NAMES = _RAW_ORDER + [n for _, n, *_ in base.ASSEMBLED if n not in _RAW_ORDER]
add("job_feature_names", f"""SELECT dataset, CAST(row_number() OVER (PARTITION BY dataset ORDER BY place) - 1 AS BIGINT) AS ordinal, feature
    FROM (VALUES {", ".join(f"('{n}', {i})" for i, n in enumerate(_JOB_NAMES))}) l(feature, place), (VALUES ('train'), ('test')) d(dataset)
    WHERE dataset = 'train' OR feature <> 'TARGET'""")
add("name_rules", f"""SELECT feature, feature LIKE 'SK\\_ID%' ESCAPE '\\' AS is_id, contains(feature, 'DAYS') AS is_days,
    contains(lower(feature), 'month') AS is_month, contains(lower(feature), 'ratio') AS is_ratio,
    contains(lower(feature), 'count') OR contains(lower(feature), 'cnt_') AS is_count FROM (VALUES {_LISTED}) l(feature, ordinal, dtype)""")
add("missing_report", f"""SELECT feature, count(*) FILTER (WHERE value IS NULL) AS missing,
    {base.single("count(*) FILTER (WHERE value IS NULL) / count(*) * 100")} AS missing_pct
    FROM all_text GROUP BY feature HAVING missing > 0""", **ALL_TEXT)
RAW = {"raw_cells": cells(NUMERIC, "stored_raw"),
       "sorted_cells": "SELECT feature, list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS v FROM raw_cells GROUP BY feature"}


def _defined(expr: str) -> str:
    return f"CASE WHEN NOT isnan({expr}) THEN {base.single(expr)} END"


add("describe_numeric", f"""SELECT feature, n, mean, std, min, {_defined(point('v', 0.25))} AS q25,
    {_defined(point('v', 0.5))} AS q50, {_defined(point('v', 0.75))} AS q75, max
    FROM sorted_cells JOIN (SELECT feature, count(value) AS n, {_defined('avg(value)')} AS mean,
    CASE WHEN count(*) FILTER (WHERE isinf(value)) = 0
         THEN {base.single('stddev_samp(CASE WHEN isfinite(value) THEN value END)')} END AS std,
    {base.single('min(value)')} AS min, {base.single('max(value)')} AS max
    FROM raw_cells GROUP BY feature) m USING (feature)""", **RAW)
add("infinity_report", """SELECT feature, count(*) FILTER (WHERE isinf(value)) AS infinities FROM raw_cells
    GROUP BY feature HAVING infinities > 0""", **RAW)
add("feature_summary", """SELECT CAST(10 AS BIGINT) AS numeric_columns, CAST(1 AS BIGINT) AS boolean_columns,
    2 + CAST(count(*) FILTER (WHERE flag NOT IN ('True', 'False')) > 0 AS BIGINT) AS categorical_columns
    FROM (SELECT CASE SK_ID_CURR % 4 WHEN 1 THEN 'True' WHEN 2 THEN 'False' WHEN 3 THEN 'False' END AS flag FROM application) f""")
add("label_distribution", "SELECT CAST(TARGET AS BIGINT) AS TARGET, count(*) AS n FROM application GROUP BY TARGET")
add("class_weights", f"""SELECT CAST(TARGET AS BIGINT) AS TARGET, count(*) AS n,
    {base.single('(SELECT count(*) FROM application) / (2 * count(*))')} AS weight FROM application GROUP BY TARGET""")
add("duplicate_report", """SELECT count(*) AS row_count,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM bureau_balance) d) AS duplicates FROM bureau_balance""")
add("drop_duplicates", "SELECT DISTINCT SK_ID_BUREAU, CAST(MONTHS_BALANCE AS BIGINT) AS MONTHS_BALANCE, STATUS FROM bureau_balance")


def _top_share(limit):
    return (f"SELECT feature, {base.single('max(n) / sum(n)')} AS top_share FROM (SELECT feature, value, count(*) AS n "
            f"FROM all_text GROUP BY feature, value) c GROUP BY feature HAVING max(n) / sum(n) >= {limit}")


add("near_constant", _top_share(0.995), **ALL_TEXT)
add("near_constant_80", _top_share(0.80), **ALL_TEXT)

CELLS = {"clean_cells": cells(NUMERIC, "stored"),
         "bounds": f"""SELECT feature, {point('v', 0.25)} AS q1, {point('v', 0.75)} AS q3,
             q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM (SELECT feature,
             list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS v FROM clean_cells GROUP BY feature) s"""}
_SKEW = ("CASE WHEN count(value) < 3 THEN NULL WHEN min(value) = max(value) THEN 0 ELSE skewness(value) END")
_OUT = "count(*) FILTER (WHERE value < lower_bound OR value > upper_bound)"
add("skew_topk", f"""SELECT feature, {base.single('s')} AS skewness FROM (SELECT feature, {_SKEW} AS s FROM clean_cells
    WHERE feature <> 'TARGET' GROUP BY feature) k ORDER BY abs(s) DESC NULLS LAST, feature LIMIT 20""", **CELLS)
add("iqr_bounds", f"""SELECT feature, {', '.join(f"{base.single(f'any_value({c})')} AS {c}" for c in
    ('q1', 'q3', 'lower_bound', 'upper_bound'))}, {_OUT} AS outliers, {base.single(f'{_OUT} / count(*) * 100')} AS outlier_pct
    FROM clean_cells JOIN bounds USING (feature) GROUP BY feature""", **CELLS)
add("column_report", f"""SELECT feature, {base.single('outlier_pct')} AS outlier_pct, {base.single('skewness')} AS skewness,
    {base.single('missing_pct')} AS missing_pct, {base.single('low')} AS min, {base.single('high')} AS max, distinct_values,
    CASE WHEN feature = 'TARGET' THEN 'Target' WHEN feature LIKE 'SK\\_ID%' ESCAPE '\\' THEN 'Ignore (ID)'
         WHEN distinct_values <= 2 THEN 'Binary' WHEN feature = 'DAYS_EMPLOYED' THEN 'Replace sentinel'
         WHEN outlier_pct < 5 THEN 'Keep' WHEN outlier_pct < 20 THEN 'Review' ELSE 'Investigate' END AS decision
    FROM (SELECT feature, round({_OUT} / count(*) * 100, 2) AS outlier_pct, round({_SKEW}, 2) AS skewness,
          round(count(*) FILTER (WHERE value IS NULL) / count(*) * 100, 2) AS missing_pct, min(value) AS low,
          max(value) AS high, count(DISTINCT value) AS distinct_values
          FROM clean_cells JOIN bounds USING (feature) GROUP BY feature) r""", **CELLS)


def _clippable(distinct: str) -> str:
    """Features with more than two values that are no key, label, day or month column."""
    return (f"SELECT feature FROM (SELECT feature, count(DISTINCT value) AS d FROM {distinct} GROUP BY feature) c "
            f"WHERE d > 2 AND feature NOT IN ('SK_ID_CURR', 'TARGET') AND feature NOT LIKE '%DAYS%' "
            f"AND lower(feature) NOT LIKE '%month%'")


add("columns_to_clip", _clippable("clean_cells"), **CELLS)
TRAIN_CELLS = {**BOTH, "train_cells": cells(NUMERIC, "(SELECT * FROM both_stored WHERE dataset = 'train') tr"),
               "train_bounds": CELLS["bounds"].replace("clean_cells", "train_cells"),
               "clippable": _clippable("train_cells")}
_CLIPPABLE = [(k, n) for k, n, *_ in base.ASSEMBLED if k != "s" and n not in ("SK_ID_CURR", "TARGET")
              and "DAYS" not in n and "month" not in n.lower()]


def _clipped(kind, name):
    if (kind, name) not in _CLIPPABLE:
        return base.shown(kind if kind == "s" or name in ("SK_ID_CURR", "TARGET") else "d", name)
    value = f'CAST("{name}" AS DOUBLE)'
    low, high = (f"(SELECT {f}_bound FROM train_bounds JOIN clippable USING (feature) WHERE feature = '{name}')"
                 for f in ("lower", "upper"))
    clamped = f"CASE WHEN {value} IS NOT NULL THEN greatest(least({value}, {high}), {low}) END"
    return f'{base.single(clamped)} AS "{name}"'


add("clip_to_iqr", "SELECT " + ", ".join(_clipped(k, n) for k, n, *_ in base.ASSEMBLED) + ", dataset FROM both_stored",
    **TRAIN_CELLS)
add("drop_near_constant", """SELECT feature, count(value) AS non_null FROM both_text WHERE feature = 'dataset'
    OR feature NOT IN (SELECT feature FROM (SELECT feature, value, count(*) AS n FROM train_text GROUP BY feature, value) c
    GROUP BY feature HAVING max(n) / sum(n) >= 0.85) GROUP BY feature""", **BOTH,
    train_text=texts(NAMES, "(SELECT * FROM both_stored_raw WHERE dataset = 'train') tr"),
    both_text=texts([*NAMES, "dataset"], "both_stored_raw"))

# rank correlation: average rank = rank of the first tied row + (ties - 1) / 2
RHO = "CASE WHEN count(DISTINCT rx) > 1 AND count(DISTINCT ry) > 1 THEN corr(rx, ry) END"
LABELLED = {
    "clean_cells": CELLS["clean_cells"],
    "labelled": cells([n for n in NUMERIC if n != "TARGET"], "stored", "TARGET", nulls=False),
    "label_ranks": """SELECT feature, rank() OVER (PARTITION BY feature ORDER BY value)
        + (count(*) OVER (PARTITION BY feature, value) - 1) / 2 AS rx, rank() OVER (PARTITION BY feature ORDER BY TARGET)
        + (count(*) OVER (PARTITION BY feature, TARGET) - 1) / 2 AS ry FROM labelled""",
    "with_label": f"SELECT feature, {RHO} AS rho FROM label_ranks GROUP BY feature",
    "top30": """SELECT feature, row_number() OVER (ORDER BY round(abs(rho), 9) DESC NULLS LAST, feature) AS place
        FROM with_label QUALIFY place <= 30""",
}
add("spearman_target", f"SELECT feature, {base.single('rho')} AS rho FROM with_label", **LABELLED)
add("top_correlated", f"SELECT feature, {base.single('rho')} AS rho FROM with_label JOIN top30 USING (feature)", **LABELLED)
MATRIX = {
    **LABELLED,
    "keyed": cells([n for n in NUMERIC if n != "SK_ID_CURR"], "stored", "SK_ID_CURR", nulls=False),
    "places": "SELECT * FROM top30 UNION ALL SELECT 'TARGET', 31",
    "placed": "SELECT SK_ID_CURR, feature, value, place FROM keyed JOIN places USING (feature)",
    "paired": """SELECT x.feature AS feature_x, y.feature AS feature_y, x.value AS a, y.value AS b
        FROM placed x JOIN placed y ON x.SK_ID_CURR = y.SK_ID_CURR AND x.place > y.place""",
    "pair_ranks": """SELECT feature_x, feature_y, rank() OVER (PARTITION BY feature_x, feature_y ORDER BY a)
        + (count(*) OVER (PARTITION BY feature_x, feature_y, a) - 1) / 2 AS rx,
        rank() OVER (PARTITION BY feature_x, feature_y ORDER BY b)
        + (count(*) OVER (PARTITION BY feature_x, feature_y, b) - 1) / 2 AS ry FROM paired""",
    "pair_rho": f"SELECT feature_x, feature_y, {RHO} AS rho FROM pair_ranks GROUP BY feature_x, feature_y",
}
add("spearman_matrix", f"""SELECT x.feature AS feature_x, y.feature AS feature_y, {base.single('rho')} AS rho FROM places x
    JOIN places y ON x.place > y.place LEFT JOIN pair_rho p ON p.feature_x = x.feature AND p.feature_y = y.feature""", **MATRIX)
BOXES = {
    **LABELLED,
    "box_cells": "SELECT TARGET, feature, value FROM labelled JOIN (SELECT feature FROM top30 WHERE place <= 20) t USING (feature)",
    "boxes": f"""SELECT TARGET, feature, {point('v', 0.25)} AS q1, {point('v', 0.5)} AS median, {point('v', 0.75)} AS q3,
        q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (SELECT TARGET, feature, list_sort(list(value)) AS v
        FROM box_cells GROUP BY TARGET, feature) s""",
}
add("box_stats", f"""SELECT CAST(TARGET AS BIGINT) AS TARGET, feature, {base.single('any_value(q1)')} AS q1,
    {base.single('any_value(median)')} AS median, {base.single('any_value(q3)')} AS q3,
    {base.single('least(min(value) FILTER (WHERE value >= low AND value <= high), any_value(q1))')} AS low_whisker,
    {base.single('greatest(max(value) FILTER (WHERE value >= low AND value <= high), any_value(q3))')} AS high_whisker,
    count(*) FILTER (WHERE value < low OR value > high) AS outliers
    FROM box_cells JOIN boxes USING (TARGET, feature) GROUP BY TARGET, feature""", **BOXES)


# --- checks ---------------------------------------------------------------------------------------

_KEYED = {"application": "SK_ID_CURR FROM application", "bureau": "SK_ID_CURR FROM bureau_features",
          "previous_application": "SK_ID_CURR FROM previous_features",
          "installments_payments": "SK_ID_CURR FROM installment_features",
          "credit_card_balance": "SK_ID_CURR FROM credit_card_features", "POS_CASH_balance": "SK_ID_CURR FROM pos_features",
          "raw_balance": "SK_ID_BUREAU FROM bureau_balance"}
add("check_keys_unique", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT k) AS key_count, count(*) = count(DISTINCT k) AS is_unique "
    f"FROM (SELECT {q.replace(' FROM', ' AS k FROM')}) q" for t, q in _KEYED.items()))
add("check_row_counts", "SELECT 'application' AS table_name, count(*) AS row_count FROM application "
                        "UNION ALL SELECT 'assembled', count(*) FROM assembled")


_WATCHED = {"applications": "application", "bureau": "bureau_features", "previous_application": "previous_features",
            "installments_payments": "installment_features", "credit_card_balance": "credit_card_features",
            "POS_CASH_balance": "pos_features", "assembled": "assembled"}
add("observed_assembly", " UNION ALL ".join(
    f"SELECT '{p}' AS place, count(*) AS row_count, count(SK_ID_CURR) AS key_rows, CAST(sum(SK_ID_CURR) AS BIGINT) AS key_sum "
    f"FROM (SELECT SK_ID_CURR FROM {t}) q" for p, t in _WATCHED.items()))
add("bucketed_assembly", select_shown(base.ASSEMBLED, "assembled"))


# --- split ----------------------------------------------------------------------------------------

def split_tables(source: str) -> dict[str, str]:
    """Membership by exact class counts in md5 order; leftovers go to the largest remainders."""
    return {
        "class_sizes": f"SELECT TARGET, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY TARGET",
        "held": "SELECT *, CAST(ceil(0.30::DOUBLE * total) AS BIGINT) AS held_rows FROM class_sizes",
        "train_sizes": """SELECT *, floor(n / total * (total - held_rows)) + CAST(row_number() OVER (ORDER BY
            n / total * (total - held_rows) - floor(n / total * (total - held_rows)) DESC, TARGET)
            <= (total - held_rows) - sum(floor(n / total * (total - held_rows))) OVER () AS INT) AS train_n FROM held""",
        "rest_sizes": """SELECT *, n - train_n AS rest, held_rows - CAST(ceil(0.5::DOUBLE * held_rows) AS BIGINT) AS val_rows
            FROM train_sizes""",
        "split_sizes": """SELECT TARGET, train_n, floor(rest / held_rows * val_rows) + CAST(row_number() OVER (ORDER BY
            rest / held_rows * val_rows - floor(rest / held_rows * val_rows) DESC, TARGET)
            <= val_rows - sum(floor(rest / held_rows * val_rows)) OVER () AS INT) AS val_n FROM rest_sizes""",
        "members": f"""SELECT s.*, CASE WHEN place <= train_n THEN 'train' WHEN place <= train_n + val_n THEN 'val'
            ELSE 'eval' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY TARGET ORDER BY
            md5(SK_ID_CURR || '-42'), SK_ID_CURR) AS place FROM {source}) s JOIN split_sizes USING (TARGET)""",
    }


APP_SPLIT, WIDE_SPLIT = split_tables("application"), split_tables("stored")
add("stratified_split", "SELECT SK_ID_CURR, CAST(TARGET AS BIGINT) AS TARGET, split FROM members", **APP_SPLIT)
add("stratified_split_sizes", "SELECT CAST(TARGET AS BIGINT) AS TARGET, split, count(*) AS n FROM members GROUP BY TARGET, split",
    **APP_SPLIT)
add("split_round_trip", select_shown(base.APPLICATION, "members WHERE split = 'val'"), **APP_SPLIT)


_BY_ID = {
    "loans": "SELECT SK_ID_BUREAU, SK_ID_CURR, CAST(SK_ID_CURR % 9 = 0 OR SK_ID_BUREAU % 501 = 0 AS INT) AS TARGET FROM bureau",
    "ids": "SELECT SK_ID_CURR, min(TARGET) AS TARGET, count(*) AS n FROM loans GROUP BY SK_ID_CURR",
    **{**split_tables("loans"), "class_sizes": """SELECT TARGET, CAST(sum(n) AS BIGINT) AS n, CAST(sum(sum(n)) OVER () AS BIGINT) AS total
        FROM ids GROUP BY TARGET""",
       "members": """SELECT SK_ID_CURR, CASE WHEN 2 * (train_n - before) >= n THEN 'train' WHEN 2 * (train_n + val_n - before) >= n
           THEN 'val' ELSE 'eval' END AS split FROM (SELECT *, sum(n) OVER (PARTITION BY TARGET ORDER BY
           md5(SK_ID_CURR || '-42'), SK_ID_CURR) - n AS before FROM ids) i JOIN split_sizes USING (TARGET)"""},
}
add("split_repeated_ids", """SELECT SK_ID_BUREAU, SK_ID_CURR, CAST(loans.TARGET AS BIGINT) AS TARGET, split
    FROM loans JOIN members USING (SK_ID_CURR)""", **_BY_ID)


# --- preprocessing --------------------------------------------------------------------------------

FILLED_NAMES = [n for k, n, *_ in base.ASSEMBLED if k != "s" and n not in ("SK_ID_CURR", "TARGET")]
_MEDIANS = ", ".join(f'quantile_cont(CAST("{n}" AS DOUBLE), 0.5) AS "{n}"' for n in FILLED_NAMES)
MEDIANS = {**WIDE_SPLIT, "medians": f"SELECT {_MEDIANS} FROM members WHERE split = 'train'",
           "filled": "SELECT m.SK_ID_CURR, m.TARGET, m.NAME_INCOME_TYPE, m.ORGANIZATION_TYPE, m.split, " + ", ".join(
               f'coalesce(CAST(m."{n}" AS DOUBLE), f."{n}") AS "{n}"' for n in FILLED_NAMES) + " FROM members m, medians f"}
_SHOWN_FILLED = [("i", "SK_ID_CURR"), ("i", "TARGET"), *[("d", n) for n in FILLED_NAMES]]
add("impute_median", select_shown(_SHOWN_FILLED + [("s", "NAME_INCOME_TYPE"), ("s", "ORGANIZATION_TYPE"), ("s", "split")], "filled"),
    **MEDIANS)


def _mode(c):
    return (f"(SELECT {c} FROM members WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)")


TEXTS = ("NAME_INCOME_TYPE", "ORGANIZATION_TYPE")
add("impute_mode", "SELECT SK_ID_CURR, " + ", ".join(f"coalesce({c}, {_mode(c)}) AS {c}" for c in TEXTS) + " FROM members",
    **WIDE_SPLIT)
_SCALE = ", ".join(
    f"struct_pack(c := quantile_cont({c}, 0.5), g := quantile_cont({c}, 0.0075) - quantile_cont({c}, 0.0025)) AS {c}"
    for c in (f'"{n}"' for n in FILLED_NAMES))
SCALES = {**MEDIANS, "scales": f"SELECT {_SCALE} FROM filled WHERE split = 'train'"}
add("robust_scale", "SELECT f.SK_ID_CURR, CAST(f.TARGET AS BIGINT) AS TARGET, " + ", ".join(
    base.single(f"""(f."{n}" - s."{n}".c) / CASE WHEN abs(s."{n}".g) < 10 * 2.220446049250313e-16::DOUBLE THEN 1 ELSE s."{n}".g END""")
    + f' AS "{n}"' for n in FILLED_NAMES) + " FROM filled f, scales s", **SCALES)
FILLED_TEXT = {**APP_SPLIT, "filled_text": "SELECT SK_ID_CURR, TARGET, split, " + ", ".join(
    f"coalesce({c}, {_mode(c)}) AS {c}" for c in TEXTS) + " FROM members"}
# the categories of the test data: five segments, 25 nations
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
VALUES = {"NAME_INCOME_TYPE": SEGMENTS, "ORGANIZATION_TYPE": tuple(sorted(f"N{i}" for i in range(25)))}


def _hot(skip):
    return "SELECT SK_ID_CURR, " + ", ".join(
        f"""CAST({c} = '{v}' AS BIGINT) AS "{c}_{v}" """ for c in TEXTS for v in VALUES[c][skip:]) + " FROM filled_text"


add("one_hot_drop_first", _hot(1), **FILLED_TEXT)
add("one_hot_full", _hot(0), **FILLED_TEXT)
add("frozen_vocab", "SELECT SK_ID_CURR, " + ", ".join(
    f"""(SELECT code FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {c} AS v FROM filled_text
        WHERE split = 'train') d) k WHERE k.v = f.{c}) AS {c}""" for c in TEXTS) + " FROM filled_text f", **FILLED_TEXT)
_FOLD = "('0x' || substr(md5(SK_ID_CURR || '-42'), 1, 7))::BIGINT % 5"


def _target_mean(c):
    return base.single(f"""coalesce((SELECT sum(t.TARGET) / nullif(count(*), 0)::DOUBLE FROM folded t WHERE t.split = 'train'
        AND t.{c} = f.{c} AND (f.split <> 'train' OR t.fold <> f.fold)),
        (SELECT avg(TARGET) FROM folded WHERE split = 'train'))""") + f" AS {c}"


add("target_encode", f"SELECT SK_ID_CURR, {', '.join(_target_mean(c) for c in TEXTS)} FROM folded f",
    **FILLED_TEXT, folded=f"SELECT *, {_FOLD} AS fold FROM filled_text")


# --- metrics and scoring ----------------------------------------------------------------------------

_DAY = "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))"
_SCORES = {
    "Elastic Net log reg": "o_totalprice / 500000",
    "XG Boost Classifier": "CAST(o_orderkey % 101 AS DOUBLE) / 100",
    "LightGBM Classifier": f"greatest(0::DOUBLE, least(1::DOUBLE, {_DAY} / 2400::DOUBLE))",
    "CatBoost Classifier": "CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice / 500000 "
                           "ELSE date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') / 2600::DOUBLE END",
}
SCORED = {
    "scored": " UNION ALL ".join(f"SELECT o_orderkey AS SK_ID_CURR, CAST(o_orderstatus = 'F' AS BIGINT) AS TARGET, '{m}' AS model, "
                                 f"{e} AS probability FROM orders" for m, e in _SCORES.items()),
    "confusion": """SELECT model, count(*) FILTER (WHERE probability > 0.5 AND TARGET = 1) AS tp,
        count(*) FILTER (WHERE probability > 0.5 AND TARGET <> 1) AS fp,
        count(*) FILTER (WHERE NOT probability > 0.5 AND TARGET = 1) AS fn,
        count(*) FILTER (WHERE NOT probability > 0.5 AND TARGET <> 1) AS tn FROM scored GROUP BY model""",
    "confused": """SELECT *, (tp + tn) / (tp + fp + fn + tn)::DOUBLE AS accuracy, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS
        "precision", coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1 FROM confusion""",
    "score_ranks": """SELECT model, TARGET, rank() OVER (PARTITION BY model ORDER BY probability)
        + (count(*) OVER (PARTITION BY model, probability) - 1) / 2 AS r FROM scored""",
    "aucs": """SELECT model, (sum(r) FILTER (WHERE TARGET = 1) - p * (p + 1) / 2) / (p * (count(*) - p)) AS roc_auc
        FROM (SELECT *, CAST(sum(TARGET) OVER (PARTITION BY model) AS DOUBLE) AS p FROM score_ranks) s GROUP BY model, p""",
}
_METRICS = [("s", "model"), ("d", "accuracy"), ("d", "precision"), ("d", "recall"), ("d", "f1")]
add("confusion_metrics", select_shown([("i", "tp"), ("i", "fp"), ("i", "fn"), ("i", "tn"), *_METRICS], "confused"), **SCORED)
add("roc_auc", f"SELECT {base.single('roc_auc')} AS roc_auc FROM aucs WHERE model = 'XG Boost Classifier'", **SCORED)
add("model_comparison", select_shown([*_METRICS, ("d", "roc_auc"), ("i", "rank")],
    "(SELECT *, row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, model) AS rank FROM confused JOIN aucs USING (model)) t"), **SCORED)
add("top2_models", f"SELECT model, {base.single('roc_auc')} AS roc_auc FROM aucs ORDER BY aucs.roc_auc DESC, model LIMIT 2", **SCORED)
add("threshold_decision", f"""SELECT SK_ID_CURR, TARGET, model, {base.single('probability')} AS probability,
    CASE WHEN probability >= 0.48 THEN 'High risk' ELSE 'Low risk' END AS decision,
    CASE WHEN probability < 0.25 THEN 'Low' WHEN probability < 0.5 THEN 'Medium' WHEN probability < 0.75 THEN 'High'
         ELSE 'Very high' END AS risk_band FROM scored""", **SCORED)


add("scored_arrivals", f"""SELECT SK_ID_CURR, TARGET, {base.single('probability')} AS probability,
    CASE WHEN probability >= 0.48 THEN 'High risk' ELSE 'Low risk' END AS decision,
    CASE WHEN probability < 0.25 THEN 'Low' WHEN probability < 0.5 THEN 'Medium' WHEN probability < 0.75 THEN 'High'
         ELSE 'Very high' END AS risk_band FROM scored WHERE model = 'CatBoost Classifier'""", **SCORED)


def _padded():
    from riskloom.sources.schemas import APPLICATION_TEST
    have = {n: k for k, n, *_ in base.APPLICATION if n not in ("TARGET", "AMT_CREDIT")}
    null = {"bigint": "BIGINT", "int": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    return ", ".join(base.shown(have[f.name], f.name) if f.name in have else
                     f'CAST(NULL AS {null[f.dataType.simpleString()]}) AS "{f.name}"' for f in APPLICATION_TEST.fields)


add("pad_missing_columns", f"SELECT {_padded()} FROM application")
add("search_summary", f"""SELECT family, {base.single('auc')} AS val_roc_auc, trial, params, trials,
    row_number() OVER (ORDER BY auc DESC, family DESC) = 1 AS winner FROM (SELECT o_orderpriority AS family, o_orderkey AS trial,
    '{{"status": "' || o_orderstatus || '"}}' AS params, round(o_totalprice / 500000, 2) AS auc,
    count(*) OVER (PARTITION BY o_orderpriority) AS trials,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY round(o_totalprice / 500000, 2) DESC, o_orderkey) AS place
    FROM orders) t WHERE place = 1""")
add("train_baselines", """SELECT model, count(*) AS scored_rows, count(*) FILTER (WHERE TARGET = 1) AS positives, true AS metrics_valid,
    true AS metrics_hold, true AS learnt, true AS ranked FROM members, (SELECT unnest(['Elastic Net log reg', 'XG Boost Classifier',
    'LightGBM Classifier', 'CatBoost Classifier']) AS model) WHERE split = 'eval' GROUP BY model""", **APP_SPLIT)
add("random_search", "SELECT CAST(t AS INTEGER) AS trial, 2 AS valid_families, 2 AS summed_up_families FROM range(3) r(t)")
add("final_model", """SELECT 'CatBoost Classifier' AS model_name, 'catbc_full' AS model_key, 'catbc' AS model_family,
    count(*) AS trained_rows, 'customer' AS source_data, '0.48' AS threshold FROM customer""")
add("score_batch", """SELECT c_custkey AS SK_ID_CURR, true AS probability_valid, true AS learnt, true AS alone_same, true AS decision_valid, true AS band_valid
    FROM customer""")
