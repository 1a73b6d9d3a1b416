"""Independent DuckDB SQL for every registered query.

The SQL is written from the operators' rules, in another form than the Spark
plans: look-back rows come from a table of (target day, source day) pairs,
the ratios of all bands and the quartiles of all entities are long tables
that are pivoted, and a ladder position is a count.  A match checks the
plans.  The input tables are rebuilt from the raw views with the fixture SQL;
limits and column names come from ``config``, days are literals.

Integer results are cast to the Spark types (BIGINT / INTEGER).  Doubles
from floating sums (page averages, report std, metrics) are rounded to 9
decimals on both sides (see ``registry.SHOWN_DIGITS``): their last bits
depend on summation order.
"""

from __future__ import annotations

from .. import config as C
from ..sources.fixtures import oracle_prelude

T = "2020-07-25"
LOOKBACK = ("2020-07-22", "2020-07-23", "2020-07-24")
ALL_DAYS = ("2020-07-22", "2020-07-23", "2020-07-24", "2020-07-25")
#: (target day, a day it looks back to)
SERVED = (
    ("2020-07-22", "2020-07-19"), ("2020-07-22", "2020-07-20"), ("2020-07-22", "2020-07-21"),
    ("2020-07-23", "2020-07-20"), ("2020-07-23", "2020-07-21"), ("2020-07-23", "2020-07-22"),
    ("2020-07-24", "2020-07-21"), ("2020-07-24", "2020-07-22"), ("2020-07-24", "2020-07-23"),
    ("2020-07-25", "2020-07-22"), ("2020-07-25", "2020-07-23"), ("2020-07-25", "2020-07-24"),
)
CONTACT = "('addf', 'success', 'p_success')"
SUCCESS = "('success', 'p_success')"
BANDS = range(1, C.N_BANDS + 1)
PLACES = range(1, C.PAGE_SIZE + 1)
#: entity -> key column
QUARTILE_KEYS = {"job": "job_id", "boss": "boss_id", "cp": "cp"}
PROFILE_LIST = ", ".join(C.PROFILE_COLUMNS)
WEEKDAY = "CAST(dayofweek(list_time) AS INTEGER)"


def _in(days) -> str:
    return "(" + ", ".join(f"'{d}'" for d in days) + ")"


def _band(col: str = "ctr_score") -> str:
    """1 plus the number of edges that the score reaches; NULL and NaN have no band."""
    return (f"CASE WHEN NOT isnan({col}) THEN CAST(1 + "
            + " + ".join(f"CAST({col} >= {e} AS INTEGER)" for e in C.BAND_EDGES) + " AS INTEGER) END")


def _quartile(entity: str, i: int) -> str:
    return f"addf_{entity}_score_q{i}_3days"


LABELLED = """scores_once AS (SELECT DISTINCT * FROM rank_scores),
labelled AS (
  SELECT boss_id, job_id, geek_id, exp_id, sessionid, s.page, s.rank, o.list_time, o.boss_position, o.boss_city,
         s.ctcvr_score, s.ctr_score, o.deal_type, ds
  FROM scores_once AS s JOIN impressions AS o USING (boss_id, job_id, geek_id, exp_id, sessionid, ds))"""


def history(days) -> str:
    """Labelled rows by the target day that looks back to them."""
    pairs = ", ".join(f"('{t}', '{d}')" for t, d in SERVED if t in days)
    return f"""served(ds, source_day) AS (VALUES {pairs}),
history AS (
  SELECT served.ds, job_id, boss_id, concat_ws('-', boss_city, boss_position) AS cp, deal_type, ctr_score, {_band()} AS band
  FROM labelled JOIN served ON labelled.ds = source_day)"""


RATIOS = f"""ratios AS (
  SELECT ds, cp, band, count(*) FILTER (deal_type IN {CONTACT}) / count(*) AS addf_ratio, CAST(count(*) AS BIGINT) AS num
  FROM history WHERE band IS NOT NULL GROUP BY ds, cp, band
  HAVING count(*) > list_extract({list(C.BAND_MIN_COUNT)}, band)),
segment AS (
  SELECT ds, cp, {", ".join(f"max(addf_ratio) FILTER (band = {b}) AS pct{b}_ratio, max(num) FILTER (band = {b}) AS pct{b}_cnt"
                            for b in BANDS)}
  FROM ratios GROUP BY ds, cp)"""

# One grouping over three key sets; grouping() tells which key a row belongs to.
QUARTILES = """quartiles AS (
  SELECT ds, job_id, boss_id, cp, grouping(job_id, boss_id, cp) AS without,
         quantile_disc(ctr_score, [0.25, 0.5, 0.75]) FILTER (NOT isnan(ctr_score)) AS q, CAST(count(*) AS BIGINT) AS n
  FROM history WHERE deal_type IN ('addf', 'success')
  GROUP BY GROUPING SETS ((ds, job_id), (ds, boss_id), (ds, cp))),
""" + ",\n".join(
    f"q_{e} AS (SELECT ds, {key}, {', '.join(f'q[{i}] AS {_quartile(e, i)}' for i in (1, 2, 3))}, "
    f"n AS {e}_addf_num_3days FROM quartiles WHERE without = {without})"
    for (e, key), without in zip(QUARTILE_KEYS.items(), (3, 5, 6)))


def sample(days) -> str:
    """Complete pages, with their scores as sorted lists and then as columns."""
    counts = ", ".join(f"CAST(count(*) FILTER (band = {b}) AS BIGINT) AS pct{b}" for b in BANDS)
    return f"""shown AS (
  SELECT *, {_band()} AS band FROM labelled WHERE ctr_score >= 0 AND NOT isnan(ctr_score) AND ds IN {_in(days)}),
page_lists AS (
  SELECT boss_id, job_id, page, sessionid, ds, CAST(hour(list_time) AS INTEGER) AS list_hour,
         CAST(list_time AS DATE) AS date, {WEEKDAY} AS weekday, boss_city AS city, boss_position AS pos,
         {counts}, CAST(count(*) AS BIGINT) AS num,
         CAST(count(*) FILTER (deal_type IN {CONTACT}) AS BIGINT) AS addf_num,
         CAST(count(*) FILTER (deal_type IN {SUCCESS}) AS BIGINT) AS suc_num,
         avg(ctr_score) AS avg_addf_score, avg(ctcvr_score) AS avg_suc_score,
         list(ctr_score ORDER BY ctr_score) AS opens,
         list(ctcvr_score ORDER BY ctcvr_score) FILTER (ctcvr_score IS NOT NULL) AS wins
  FROM shown GROUP BY ALL HAVING count(*) = {C.PAGE_SIZE}),
sample AS (
  SELECT * EXCLUDE (opens, wins), concat_ws('-', city, pos) AS cp,
         {", ".join(f"opens[{n}] AS addf_{n}, wins[{n}] AS suc_{n}" for n in PLACES)}
  FROM page_lists)"""


def profiles(days) -> str:
    return f"""prof AS (
  SELECT DISTINCT boss_id, job_id, sessionid, page, rank, CAST(list_time AS DATE) AS date, {PROFILE_LIST}, ds
  FROM impressions WHERE source = '{C.PROFILE_SOURCE}' AND rank = '{C.PROFILE_RANK}' AND ds IN {_in(days)})"""


BLOCKS = "block AS (SELECT DISTINCT boss_id, job_id, business FROM job_blocks)"


def _reference(i: int) -> str:
    """The job's quartile, else the boss's, else the segment's."""
    return "coalesce(" + ", ".join(_quartile(e, i) for e in QUARTILE_KEYS) + ")"


def _ladder(i: int) -> str:
    """How many of the page's scores reach the reference quartile."""
    reach = " + ".join(f"CAST(addf_{n} >= {_reference(i)} AS INTEGER)" for n in PLACES)
    return f"CAST(coalesce({reach}, 0) AS INTEGER)"


def _strict_ratio(i: int) -> str:
    return (f"coalesce({_quartile('job', i)}, {_quartile('boss', i)}) / nullif({_quartile('cp', i)}, 0) - 1")


def _page_base() -> str:
    parts = " ".join(f"WHEN page <= {last} THEN {weight}" for last, weight in C.PAGE_WEIGHT_STEPS)
    return f"CAST(CASE {parts} ELSE {C.PAGE_WEIGHT_DEFAULT} END AS DOUBLE)"


def _mean3(prefix: str) -> str:
    """Mean of a page's scores at 3 decimals, half up, in whole millionths."""
    values = "[" + ", ".join(f"{prefix}_{n}" for n in PLACES) + "]"
    n, total = f"list_count({values})", f"list_sum([CAST(round(v * 1000000) AS BIGINT) FOR v IN {values}])"
    return f"CASE WHEN {n} > 0 THEN CAST((2 * {total} + {n} * 1000) // (2 * {n} * 1000) AS DOUBLE) / 1000 END"


def _mean_without_nan(prefix: str) -> str:
    values = "[" + ", ".join(f"{prefix}_{n}" for n in PLACES) + "]"
    kept = f"[v FOR v IN {values} IF v IS NOT NULL AND NOT isnan(v)]"
    total = f"list_sum([CAST(round(v * 1000000) AS BIGINT) FOR v IN {kept}])"
    return f"CASE WHEN len({kept}) > 0 THEN CAST((2 * {total} + len({kept}) * 1000) // (2 * len({kept}) * 1000) AS DOUBLE) / 1000 END"


WITH_QUARTILES = ("FROM sample LEFT JOIN q_job USING (ds, job_id) LEFT JOIN q_boss USING (ds, boss_id) "
                  "LEFT JOIN q_cp USING (ds, cp)")

JOINED = (
    "joined AS (SELECT sample.* REPLACE (" + _mean3("addf") + " AS avg_addf_score, " + _mean3("suc") + " AS avg_suc_score), "
    + ", ".join(f"pct{b}_ratio" for b in BANDS) + ", "
    + ", ".join(f"{_quartile(e, i)}" for e in QUARTILE_KEYS for i in (1, 2, 3)) + ", "
    + ", ".join(f"{e}_addf_num_3days" for e in QUARTILE_KEYS) + ", "
    + ", ".join(f"{_strict_ratio(i)} AS q{i}_strict, {_ladder(i)} AS q{i}_base" for i in (1, 2, 3)) + ", "
    + f"{_page_base()} AS page_base, CAST(coalesce(business, 0) AS INTEGER) AS business_type, {PROFILE_LIST} "
    + WITH_QUARTILES
    + " LEFT JOIN segment USING (ds, cp) LEFT JOIN block USING (boss_id, job_id)"
    " LEFT JOIN prof USING (boss_id, job_id, sessionid, page, date, ds))")


def _class(i: int, low: int | None = None) -> str:
    """Class of a strictness ratio; ``low`` names the ratio that the first limit tests."""
    first, second = C.STRICT_LIMITS[f"q{i}"]
    return (f"CAST(CASE WHEN q{low or i}_strict < {first} THEN 1 WHEN q{i}_strict < {second} THEN 2 "
            f"WHEN q{i}_strict > {second} THEN 3 ELSE 0 END AS INTEGER)")


# The third class tests the first ratio, as the job does.
CLASSES = {1: _class(1), 2: _class(2), 3: _class(3, 1)}


def _product(b: int) -> str:
    return f"coalesce(pct{b} * pct{b}_ratio, 0)"


PRODUCTS = ", ".join(f"{_product(b)} AS multi_pct{b}" for b in BANDS)
PCT_SUM = " + ".join(_product(b) for b in BANDS) + " AS pct_sum"
FINAL = (f"final AS (SELECT {', '.join(C.FINAL_COLUMNS)}, ds FROM (SELECT * REPLACE ("
         + ", ".join(f"{c} AS q{i}_strict" for i, c in CLASSES.items()) + f"), {PRODUCTS}, {PCT_SUM} FROM joined))")


def joined_chain(days=(T,)) -> list[str]:
    return [LABELLED, history(days), RATIOS, QUARTILES, sample(days), profiles(days), BLOCKS, JOINED]


def final_chain(days=(T,)) -> list[str]:
    return [*joined_chain(days), FINAL]


# CTE chains of the target day
FEATURES = [LABELLED, history((T,)), RATIOS, QUARTILES]
PAGES = [LABELLED, sample((T,))]


NAN = """spoiled AS (
  SELECT * REPLACE (CASE WHEN (geek_id + exp_id) % 17 = 0 THEN 'NaN'::DOUBLE ELSE ctr_score END AS ctr_score,
                    CASE WHEN (geek_id + exp_id) % 19 = 0 THEN 'NaN'::DOUBLE ELSE ctcvr_score END AS ctcvr_score) FROM labelled)"""


def over_nan(*ctes: str) -> list[str]:
    """The chain over labelled rows some of whose scores are NaN."""
    return [LABELLED, NAN, *[c.replace("FROM labelled", "FROM spoiled").replace("labelled.ds", "spoiled.ds") for c in ctes]]


def with_(ctes, body: str) -> str:
    pre = oracle_prelude()
    if ctes:
        pre = pre.rstrip() + ",\n" + ",\n".join(ctes) + "\n"
    return pre + body


# ---------------------------------------------------------------- per-query SQL

ROW_KEYS = "boss_id, job_id, geek_id, exp_id, sessionid, ds"
PAGE_KEYS = "boss_id, job_id, sessionid, page, list_hour, date, weekday, city, pos, ds"


def _report(table: str = "final") -> str:
    """Long table of the reported columns, grouped by column and label; the smallest labels of each."""
    lo, hi = "2020-07-14", "2020-07-26"
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, addf_num FROM {table} WHERE ds BETWEEN '{lo}' AND '{hi}'"
                              for c in C.REPORT_COLUMNS)
    return (f"SELECT feature, q[1] AS q25, q[2] AS q50, q[3] AS q75, q[4] AS q90, round(std, 9) AS std, addf_num, num FROM ("
            f"SELECT feature, addf_num, quantile_disc(value, {list(C.REPORT_PROBS)}) AS q, stddev_pop(value) AS std, "
            f"CAST(count(*) AS BIGINT) AS num FROM ({long}) GROUP BY feature, addf_num "
            f"QUALIFY row_number() OVER (PARTITION BY feature ORDER BY addf_num) <= {C.REPORT_LIMIT})")


def _text_select() -> str:
    return ", ".join("pos AS position" if c == "pos" else c for c in C.FINAL_COLUMNS)


def _features_in_layout() -> list[str]:
    wanted = set(C.ADDF_FEATURES + C.SUCCESS_FEATURES + C.CATEGORICAL_FEATURES + C.NUMERIC_FEATURES
                 + C.HASH_FEATURES + C.LABELS)
    return [c for c in C.TEXT_COLUMNS if c in wanted]


def _filled(c: str) -> str:
    if c in C.LABELS:
        return c
    if c in C.CATEGORICAL_FEATURES:
        return f"CAST(coalesce(CAST({c} AS INTEGER), 0) AS INTEGER) AS {c}"
    if c in C.HASH_FEATURES:
        return f"coalesce(CAST({c} AS VARCHAR), '0') AS {c}"
    return f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}"


TEXT = f"text AS (SELECT {_text_select()}, ds FROM final)"
FILLED = ("filled AS (SELECT " + ", ".join(_filled(c) for c in _features_in_layout())
          + ", sessionid, page, job_id, ds FROM text)")
MODEL_KEYS = "boss_id, job_id, sessionid, page, ds"
# The training text and the model read every back-filled day.
TEXT_CHAIN = [*final_chain(ALL_DAYS), TEXT]
MODEL_CHAIN = [*TEXT_CHAIN, FILLED]


def _bucket(c: str) -> str:
    lim = C.BUCKET_LIMITS[c]
    return f"CAST(len([b FOR b IN {[float(x) for x in lim]} IF b <= {c}]) AS INTEGER) AS {c}_bucket"


def _vocab(c: str) -> str:
    v = C.VOCABULARIES[c]
    return f"CAST(coalesce(nullif(list_position({list(v)}, {c}), 0) - 1, {len(v)}) AS INTEGER) AS {c}_index"


def _hash(c: str, n: int) -> str:
    return (f"CAST(CAST(('0x' || substr(md5(coalesce(CAST({c} AS VARCHAR), '0')), 1, 15)) AS BIGINT) % {n} "
            f"AS INTEGER) AS {c}_hash")


def _encoded() -> str:
    """Width, non-zero slots and sum of the assembled vector: plain numbers, then one slot for each one-hot.

    Values outside a vocabulary have no slot.
    """
    plain = [*C.NUMERIC_FEATURES, *(c for c in C.ADDF_FEATURES if c != "avg_addf_score")]
    known = " + ".join(f"CAST({c} IN ({', '.join(map(str, C.VOCABULARIES[c]))}) AS INTEGER)" for c in C.CATEGORICAL_FEATURES)
    always = len(C.BUCKET_LIMITS) + len(C.HASH_SIZES)
    width = (len(plain) + sum(len(x) + 1 for x in C.BUCKET_LIMITS.values())
             + sum(len(C.VOCABULARIES[c]) for c in C.CATEGORICAL_FEATURES) + sum(C.HASH_SIZES.values()))
    return (f"SELECT {MODEL_KEYS}, CAST({width} AS INTEGER) AS n_features, "
            f"CAST({' + '.join(f'CAST({c} <> 0 AS INTEGER)' for c in plain)} + {known} + {always} AS INTEGER) AS nnz, "
            f"round({' + '.join(plain)} + {known} + {always}, 6) AS feature_sum FROM filled")


# ---------------------------------------------------------------- the network's inputs and its forward pass

def _list(items) -> str:
    return "[" + ", ".join(items) + "]"


def _hot(index: str, n: int) -> str:
    return f"[CASE WHEN k = ({index}) THEN 1.0::DOUBLE ELSE 0.0 END FOR k IN range({n})]"


def _joined_lists(lists) -> str:
    return "list_concat(" + ", ".join(lists) + ")"


def _wide() -> str:
    raw = _list(f"{c}::DOUBLE" for c in C.ADDF_FEATURES if c != "avg_addf_score")
    return _joined_lists([raw, *[_hot(f"len([b FOR b IN {[float(x) for x in lim]} IF b <= {c}])", len(lim) + 1)
                                 for c, lim in C.BUCKET_LIMITS.items()]])


def _plain() -> str:
    return _joined_lists([_list(f"{c}::DOUBLE" for c in C.NUMERIC_FEATURES),
                          *[_hot(f"list_position({list(C.VOCABULARIES[c])}, {c}) - 1", len(C.VOCABULARIES[c]))
                            for c in C.CATEGORICAL_FEATURES]])


def _bucket_of(c: str) -> str:
    return f"(('0x' || substr(md5(coalesce(CAST({c} AS VARCHAR), '0')), 1, 15))::BIGINT % {C.HASH_SIZES[c]})"


def _embedding(c: str) -> str:
    digest = f"md5('42:{c}:' || {_bucket_of(c)} || ':' || k)"
    return f"[(('0x' || substr({digest}, 1, 8))::BIGINT::DOUBLE / 2147483648 - 1) / sqrt(32) FOR k IN range(32)]"


def _vector_numbers(name: str, value: str) -> str:
    return (f"CAST(len({value}) AS INTEGER) AS n_{name}, CAST(len([x FOR x IN {value} IF x <> 0]) AS INTEGER) AS {name}_nnz, "
            f"round(list_sum({value}), 6) AS {name}_sum")


#: layer sizes of the network, and the first parameter of each layer
LAYERS = ((205, 64), (64, 32), (32, 16), (16, 8), (102, 1))
FIRST = [sum((a + 1) * b for a, b in LAYERS[:k]) for k in range(len(LAYERS))]
DENSE_BLOCKS = -(-sum((a + 1) * b for a, b in LAYERS) // 32)


def _given(block: str, place: str) -> str:
    """The given weights: a fixed pattern over blocks of 32 parameters and places in them."""
    return f"((({block}) * 31 + ({place}) * 17) % 101 - 35)::DOUBLE / 1000"


def _flat(n: str) -> str:
    return _given(f"({n}) // 32", f"({n}) % 32")


def forward_chain() -> list[str]:
    """Predictions of the network with given weights: one row a unit, layer by layer."""
    first_block, parts = DENSE_BLOCKS, []
    for c, n in C.HASH_SIZES.items():
        parts.append(f"[{_given(f'{first_block} + {_bucket_of(c)}', 'k')} FOR k IN range(32)]")
        first_block += n
    steps = [f"""inputs AS MATERIALIZED (
  SELECT row_number() OVER () AS id, {MODEL_KEYS}, addf_num, {_wide()} AS wide, {_joined_lists([_plain(), *parts])} AS x0 FROM filled)"""]
    for k, (a, b) in enumerate(LAYERS):
        x = "list_concat(x, wide)" if k == len(LAYERS) - 1 else "x"
        source = "SELECT id, x0 AS x, wide FROM inputs" if k == 0 else f"SELECT id, x, wide FROM layer{k} JOIN inputs USING (id)"
        steps.append(f"""weights{k + 1} AS MATERIALIZED (
  SELECT o, [{_flat(f'{FIRST[k]} + i * {b} + o')} FOR i IN range({a})] AS w, {_flat(f'{FIRST[k] + a * b} + o')} AS bias FROM range({b}) AS t(o)),
layer{k + 1} AS MATERIALIZED (
  SELECT id, list(greatest(list_dot_product({x}, w) + bias, 0) ORDER BY o) AS x FROM ({source}), weights{k + 1} GROUP BY id)""")
    steps.append(f"predicted AS (SELECT {MODEL_KEYS}, addf_num, x[1] AS prediction FROM inputs JOIN layer{len(LAYERS)} USING (id))")
    return steps


def oracle_sql() -> dict[str, str]:
    lo, hi = "2020-07-14", "2020-07-26"
    q = {
        "scan_day": with_([], f"SELECT * FROM rank_scores WHERE ds = '{T}'"),
        "scan_lookback": with_([], f"SELECT * FROM rank_scores WHERE ds IN {_in(LOOKBACK)}"),
        "scan_range": with_([], f"SELECT * FROM rank_scores WHERE ds BETWEEN '{lo}' AND '{hi}'"),
        "scan_dim": with_([], "SELECT * FROM job_blocks"),
        "distinct_rows": with_([], "SELECT DISTINCT * FROM job_blocks"),
        "overwrite_day": with_([], "SELECT * FROM rank_scores WHERE ds <> '2020-07-24'"),  # the day emptied at the end
        "weekday_number": with_([], f"SELECT {ROW_KEYS}, CAST(list_time AS DATE) AS date, "
                                    f"CAST(hour(list_time) AS INTEGER) AS list_hour, {WEEKDAY} AS weekday "
                                    "FROM impressions"),
        "composite_key": with_([], f"SELECT {ROW_KEYS}, concat_ws('-', boss_city, boss_position) AS cp "
                                   "FROM impressions"),
        "outcome_flags": with_([], f"SELECT {ROW_KEYS}, deal_type, "
                                   f"CAST(coalesce(deal_type IN {CONTACT}, false) AS INTEGER) AS addf_flag, "
                                   f"CAST(coalesce(deal_type IN {SUCCESS}, false) AS INTEGER) AS suc_flag "
                                   "FROM impressions"),
        "score_band": with_([], f"SELECT {ROW_KEYS}, ctr_score, {_band()} AS band FROM rank_scores"),
        "label_impressions": with_([LABELLED], "SELECT * FROM labelled"),
        "band_ratio": with_(FEATURES, "SELECT * FROM ratios"),
        "band_ratio_wide": with_(FEATURES, "SELECT * FROM segment"),
        **{f"quartiles_by_{e}": with_(FEATURES, f"SELECT * RENAME ({e}_addf_num_3days AS num) FROM q_{e}")
           for e in QUARTILE_KEYS},
        "nan_band_ratio": with_(over_nan(history((T,)), RATIOS), "SELECT * FROM ratios"),
        "nan_quartiles": with_(over_nan(history((T,)), QUARTILES),
                               "SELECT ds, CASE without WHEN 3 THEN 'job' WHEN 5 THEN 'boss' ELSE 'cp' END AS entity, job_id, boss_id, cp, "
                               "q[1] AS q1, q[2] AS q2, q[3] AS q3, n AS num FROM quartiles"),
        "nan_pages": with_(over_nan(sample((T,))), f"SELECT {PAGE_KEYS}, num, addf_1, addf_15, {_mean3('addf')} AS avg_addf_score, "
                           f"{_mean_without_nan('suc')} AS avg_suc_score FROM sample"),
        "page_samples": with_(PAGES, "SELECT * REPLACE (round(avg_addf_score, 9) AS avg_addf_score, "
                                     "round(avg_suc_score, 9) AS avg_suc_score) FROM sample"),
        "page_histogram": with_(PAGES, f"SELECT {PAGE_KEYS}, {', '.join(f'pct{b}' for b in BANDS)}, num FROM sample"),
        "ratio_join": with_(FEATURES + [sample((T,))],
                            f"SELECT {PAGE_KEYS}, {', '.join(f'pct{b}_ratio' for b in BANDS)} "
                            "FROM sample LEFT JOIN segment USING (ds, cp)"),
        "block_join": with_(PAGES + [BLOCKS],
                            f"SELECT {PAGE_KEYS}, CAST(coalesce(business, 0) AS INTEGER) AS business_type "
                            "FROM sample LEFT JOIN block USING (boss_id, job_id)"),
        "profile_rows": with_([profiles((T,))], "SELECT * EXCLUDE (ds) FROM prof"),
        "profile_join": with_(PAGES + [profiles((T,))],
                              f"SELECT {PAGE_KEYS}, {PROFILE_LIST} FROM sample "
                              "LEFT JOIN prof USING (boss_id, job_id, sessionid, page, date, ds)"),
        "fallback_quantile": with_(FEATURES + [sample((T,))],
                                   f"SELECT {PAGE_KEYS}, {', '.join(f'{_reference(i)} AS q{i}_ref' for i in (1, 2, 3))} "
                                   + WITH_QUARTILES),
        "strictness_ratio": with_(FEATURES + [sample((T,))],
                                  f"SELECT {PAGE_KEYS}, {', '.join(f'{_strict_ratio(i)} AS q{i}_strict' for i in (1, 2, 3))} "
                                  + WITH_QUARTILES),
        "ladder_position": with_(FEATURES + [sample((T,))],
                                 f"SELECT {PAGE_KEYS}, {', '.join(f'{_ladder(i)} AS q{i}_base' for i in (1, 2, 3))} "
                                 + WITH_QUARTILES),
        "page_weight": with_(PAGES, f"SELECT {PAGE_KEYS}, {_page_base()} AS page_base FROM sample"),
        "joined_rows": with_(joined_chain(), "SELECT * FROM joined"),
        "strictness_class": with_(joined_chain(), f"SELECT {PAGE_KEYS}, business_type, "
                                  + ", ".join(f"{c} AS q{i}_class" for i, c in CLASSES.items()) + " FROM joined"),
        "expected_contacts": with_(joined_chain(), f"SELECT {PAGE_KEYS}, business_type, {PRODUCTS}, {PCT_SUM} FROM joined"),
        "final_rows": with_(final_chain(), "SELECT * FROM final"),
        "final_rows_backfill": with_(final_chain(ALL_DAYS), "SELECT * FROM final"),
        "threshold_report": with_(final_chain(ALL_DAYS), _report()),
        "report_file": with_(final_chain(ALL_DAYS), _report()),
        "tsv_roundtrip": with_(TEXT_CHAIN, "SELECT * FROM text"),
        "read_days_existing": with_(TEXT_CHAIN, f"SELECT {MODEL_KEYS}, "
                                    "'2020-07-22,2020-07-23,2020-07-24,2020-07-25' AS days_found FROM text"),
        "feature_select": with_(TEXT_CHAIN, f"SELECT {', '.join(_features_in_layout())}, ds FROM text"),
        "fill_defaults": with_(TEXT_CHAIN, f"SELECT {', '.join(_filled(c) for c in _features_in_layout())}, ds FROM text"),
        "date_split": with_([LABELLED], f"SELECT {ROW_KEYS}, CASE ds WHEN '{T}' THEN 'test' ELSE 'train' END AS split "
                                        f"FROM labelled WHERE ds IN ('2020-07-22', '2020-07-23', '{T}')"),
        "bucketize": with_(MODEL_CHAIN, f"SELECT {MODEL_KEYS}, "
                                        + ", ".join(_bucket(c) for c in C.BUCKET_LIMITS) + " FROM filled"),
        "vocab_onehot": with_(MODEL_CHAIN, f"SELECT {MODEL_KEYS}, "
                                           + ", ".join(_vocab(c) for c in C.CATEGORICAL_FEATURES) + " FROM filled"),
        "hash_bucket": with_(MODEL_CHAIN, f"SELECT {MODEL_KEYS}, "
                                          + ", ".join(_hash(c, n) for c, n in C.HASH_SIZES.items())
                                          + " FROM filled"),
        "encoded_rows": with_(MODEL_CHAIN, _encoded()),
        "wide_deep_vectors": with_(MODEL_CHAIN, f"SELECT {MODEL_KEYS}, {_vector_numbers('wide', 'wide')}, {_vector_numbers('deep', 'deep')} FROM ("
                                   f"SELECT {MODEL_KEYS}, {_wide()} AS wide, {_joined_lists([_plain(), *map(_embedding, C.HASH_SIZES)])} AS deep FROM filled)"),
        "embedding_lookup": with_(MODEL_CHAIN, f"SELECT {MODEL_KEYS}, " + ", ".join(
            f"round(e_{c}[1], 9) AS {c}_first, round(e_{c}[32], 9) AS {c}_last, round(list_sum(e_{c}), 9) AS {c}_sum" for c in C.HASH_SIZES)
            + f" FROM (SELECT {MODEL_KEYS}, " + ", ".join(f"{_embedding(c)} AS e_{c}" for c in C.HASH_SIZES) + " FROM filled)"),
        "score_rows": with_(MODEL_CHAIN + forward_chain(), f"SELECT {MODEL_KEYS}, round(prediction, 9) AS prediction FROM predicted"),
        "evaluate_splits": with_(MODEL_CHAIN + forward_chain(),
                                 f"SELECT CASE ds WHEN '{T}' THEN 'test' ELSE 'train' END AS split, "
                                 "round(sqrt(avg(pow(prediction - addf_num, 2))), 9) AS rmse, round(avg(abs(prediction - addf_num)), 9) AS mae, "
                                 "round(avg(pow(prediction - addf_num, 2)), 9) AS mse, "
                                 f"round(avg(pow(least(prediction, {C.PREDICTION_CAP}) - addf_num, 2)), 9) AS mse_clipped, "
                                 "CAST(count(*) AS BIGINT) AS n FROM predicted GROUP BY ALL"),
        "shuffled_rows": with_(MODEL_CHAIN, f"SELECT *, place // 1000 AS batch FROM (SELECT {MODEL_KEYS}, row_number() OVER (ORDER BY "
                               f"('0x' || substr(md5(concat_ws('|', '11', {', '.join(f'CAST({k} AS VARCHAR)' for k in MODEL_KEYS.split(', '))})), 1, 15))::BIGINT, "
                               f"{MODEL_KEYS}) - 1 AS place FROM filled)"),
        "eval_metrics": with_(final_chain(ALL_DAYS),
                              "SELECT round(sqrt(avg(pow(pct_sum - addf_num, 2))), 9) AS rmse, "
                              "round(avg(abs(pct_sum - addf_num)), 9) AS mae, "
                              "round(avg(pow(pct_sum - addf_num, 2)), 9) AS mse, "
                              f"round(avg(pow(least(pct_sum, {C.PREDICTION_CAP}) - addf_num, 2)), 9) AS mse_clipped, "
                              "CAST(count(*) AS BIGINT) AS n FROM final"),
    }
    return q
