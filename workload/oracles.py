"""SQL side: the same results for DuckDB."""

from __future__ import annotations

from millwright.operators.evaluation import METRICS
from millwright.schema import FEATURES, TARGET
from workload import fixtures as fx
from workload.fixtures import base_and_batch_sql, split_sql, with_sql

_F1K_SPLIT = ("f1k", split_sql("f1k", TARGET, fx.KEY))
_SPLIT_ROWS = with_sql(*_F1K_SPLIT, select="select * from parts")
_SENSOR = {s.name: s for s in fx.SENSORS}


def _names_where(test) -> str:
    cells = ", ".join(f"case when {test(s)} then '{s.name}' end" for s in fx.SENSORS)
    return f"concat_ws(',', {cells})"


def _refused(s) -> str:
    return f"({s.name} is null or not ({s.name} between {s.low!r} and {s.high!r}))"


def _per_sensor(first, second, names) -> str:
    return "\nunion all\n".join(
        f"select '{s.name}' sensor, cast(count(*) filter (where {first(s)}) as bigint) {names[0]},"
        f" cast(count(*) filter (where {second(s)}) as bigint) {names[1]} from f5"
        for s in fx.SENSORS
    )


VIOLATIONS = _names_where(_refused)
UNUSUAL = _names_where(
    lambda s: f"{s.name} is not null and not ({s.name} between {s.seen_low!r} and {s.seen_high!r})"
)


def _metrics(name: str, score: str, label: str = TARGET) -> tuple[str, ...]:
    """CTEs ending in a one-row table ``name`` of the five metrics."""
    s = name
    return (
        f"""{s}_counts as (select {score} score, sum({label}) pos, count(*) - sum({label}) neg
    from f1 group by 1)""",
        f"""{s}_below as (select score, pos, neg,
    sum(neg) over (order by score rows unbounded preceding) - neg below from {s}_counts)""",
        f"""{s}_sums as (select
    coalesce(sum(pos) filter (where score > 0.5E0), 0) tp,
    coalesce(sum(neg) filter (where score > 0.5E0), 0) fp,
    coalesce(sum(pos) filter (where not score > 0.5E0), 0) fn,
    coalesce(sum(neg) filter (where not score > 0.5E0), 0) tn,
    sum(pos * (2 * below + neg)) wins, sum(pos) p, sum(neg) n from {s}_below)""",
        f"""{s} as (select cast(tp + tn as double) / cast(tp + fp + fn + tn as double) accuracy,
    coalesce(cast(tp as double) / nullif(cast(tp + fp as double), 0), 0.0E0) "precision",
    coalesce(cast(tp as double) / nullif(cast(tp + fn as double), 0), 0.0E0) recall,
    coalesce(cast(2 * tp as double) / nullif(cast(2 * tp + fp + fn as double), 0), 0.0E0) f1_score,
    cast(wins as double) / cast(2 * p * n as double) roc_auc from {s}_sums)""",
    )


def _long(name: str) -> str:
    return "\nunion all ".join(f"""select '{m}' metric, "{m}" "value" from {name}""" for m in METRICS)


_COMPARISON = (
    "f1",
    *_metrics("mb", fx.SCORER_B_SQL),
    *_metrics("ma", fx.SCORER_A_SQL),
    f"existing as ({_long('mb')})",
    f"new as ({_long('ma')})",
    """compared as (select e.metric, e."value" existing_value, n."value" new_value,
    n."value" - e."value" diff from existing e join new n on e.metric = n.metric)""",
)

_CONFUSION_B = f"""conf as (select
    cast(count(*) filter (where {TARGET} = 1 and s > 0.5E0) as bigint) tp,
    cast(count(*) filter (where {TARGET} = 0 and s > 0.5E0) as bigint) fp,
    cast(count(*) filter (where {TARGET} = 1 and not s > 0.5E0) as bigint) fn,
    cast(count(*) filter (where {TARGET} = 0 and not s > 0.5E0) as bigint) tn
    from (select {TARGET}, {fx.SCORER_B_SQL} s from f1))"""


def _scored(source: str, scorer: str = fx.SCORER_A_SQL) -> str:
    return f"""checked as (select *, {VIOLATIONS} violations from {source}),
  probs as (select *, violations = '' accepted,
    case when violations = '' then {scorer} end probability from checked),
  scored as (select *,
    case when probability > 0.5E0 then 1 when probability is not null then 0 end prediction,
    case when probability is not null
      then printf('%.2f%%', (1.0E0 - probability) * 100.0E0) end normal_percent,
    case when probability is not null
      then printf('%.2f%%', probability * 100.0E0) end maintenance_percent,
    case when probability > 0.5E0 then 'Maintenance Required'
      when probability is not null then 'Normal Operation' end condition from probs)"""


_FILLED = "filled as (select src_key, " + ", ".join(
    f"coalesce({c}, {_SENSOR[c].default!r}E0) {c}" for c in FEATURES
) + f", {TARGET} from f5)"

# The advice lines, as the operator has to give them.
_ADVICE = """advice_lines as (select * from (values
  (0, 1, 'Current Status: Healthy', 'Continue regular monitoring'),
  (0, 2, 'Current Status: Healthy', 'Maintain current maintenance schedule'),
  (0, 3, 'Current Status: Healthy', 'Monitor for any sudden changes in sensor readings'),
  (0, 4, 'Current Status: Healthy', 'Schedule next routine inspection as planned'),
  (1, 1, 'Immediate Actions Required:', 'Schedule comprehensive engine inspection'),
  (1, 2, 'Immediate Actions Required:', 'Check lubrication system'),
  (1, 3, 'Immediate Actions Required:', 'Inspect cooling system'),
  (1, 4, 'Immediate Actions Required:', 'Review fuel delivery system'),
  (1, 5, 'Immediate Actions Required:', 'Monitor engine closely until serviced'),
  (1, 6, 'Immediate Actions Required:', 'Consider reducing operational load')
  ) t(prediction, line_no, status, advice))"""

_FLAGS = ", ".join(
    f"{n} as (select * from (values (false), (true)) t({n[:-2]}))"
    for n in ("trained_s", "has_existing_s", "compare_s", "force_s", "data_updated_s")
)

_BINNED = f"""binned as (select cast(floor(engine_rpm / 3.5E3) as integer) b1,
    cast(floor(lub_oil_pressure / 2.0E0) as integer) b2,
    cast(floor(fuel_pressure * 2.5E2) as integer) b3, {TARGET} y from f1)"""


def _gains(name: str, rows: str) -> tuple[str, ...]:
    """CTEs ending in ``name``: every valid cut per node of ``rows`` (node, b1..b3, y)."""
    n = name
    return (
        f"""{n}_u as (select node, 'engine_rpm' feature, b1 bin, y from {rows}
    union all select node, 'lub_oil_pressure', b2, y from {rows}
    union all select node, 'fuel_pressure', b3, y from {rows})""",
        f"""{n}_h as (select node, feature, bin, 0.5E0 * count(*) - sum(y) g, 0.25E0 * count(*) h
    from {n}_u group by node, feature, bin)""",
        f"""{n}_c as (select node, feature, bin,
    sum(g) over (partition by node, feature order by bin rows unbounded preceding) gl,
    sum(h) over (partition by node, feature order by bin rows unbounded preceding) hl,
    sum(g) over (partition by node, feature) gt, sum(h) over (partition by node, feature) ht
    from {n}_h)""",
        f"{n}_t as (select *, gt - gl gr, ht - hl hr from {n}_c)",
        f"""{n}_z as (select *, greatest(abs(gl) - 0.5E0, 0.0E0) tl,
    greatest(abs(gr) - 0.5E0, 0.0E0) tr, greatest(abs(gt) - 0.5E0, 0.0E0) tp from {n}_t)""",
        f"""{n}_g as (select node, feature, bin, gl, hl, gr, hr, tl, tr,
    tl * tl / (hl + 7.0E0) + tr * tr / (hr + 7.0E0) - tp * tp / (ht + 7.0E0) gain from {n}_z)""",
        f"{n} as (select * from {n}_g where hl >= 1.0E1 and hr >= 1.0E1 and gain > 0.5E0)",
    )


def _best(name: str, gains: str) -> str:
    return f"""{name} as (select node, feature, bin, gain,
    0.01E0 * case when gl < 0 then tl else -tl end / (hl + 7.0E0) left_value,
    0.01E0 * case when gr < 0 then tr else -tr end / (hr + 7.0E0) right_value
    from {gains} qualify row_number() over (partition by node order by gain desc, feature, bin) = 1)"""


_SPLIT_GAIN = ("f1", _BINNED, "at_root as (select 0 node, * from binned)", *_gains("gains", "at_root"))

_USABLE = "not (src_key % 43 = 0 or src_key % 31 = 0 or src_key % 37 = 0 or src_key % 41 = 0" \
    " or (src_key % 23 <> 0 and src_key % 29 = 0))"


def _gap_metrics(name: str, score: str, usable: str) -> str:
    """The five metrics of a scorer over the usable rows of ``f5``, and the numbers of rows."""
    return f"""{name}_c as (select {score} s, sum({TARGET}) pos, count(*) - sum({TARGET}) neg
    from f5 where {usable} group by 1),
  {name}_b as (select *, sum(neg) over (order by s rows unbounded preceding) - neg below from {name}_c),
  {name}_t as (select sum(pos) p, sum(neg) n, sum(pos * (2 * below + neg)) wins,
    coalesce(sum(pos) filter (where s > 0.5E0), 0) tp, coalesce(sum(neg) filter (where s > 0.5E0), 0) fp from {name}_b),
  {name}_m as (select cast(tp + n - fp as double) / cast(p + n as double) accuracy,
    cast(tp as double) / cast(tp + fp as double) "precision", cast(tp as double) / cast(p as double) recall,
    cast(2 * tp as double) / cast(2 * tp + fp + p - tp as double) f1_score,
    cast(wins as double) / cast(2 * p * n as double) roc_auc, cast(p + n as bigint) test_rows from {name}_t)"""


_GAPS = with_sql(
    "f1", "f5",
    _gap_metrics("strict", fx.SCORER_A_SQL, "engine_rpm is not null and fuel_pressure is not null"),
    _gap_metrics("filled", f"case when engine_rpm is null then 0.25E0 else {fx.SCORER_A_SQL} end", "true"),
    select="""select *, (select count(*) from f5) - test_rows unusable_test_rows, 'left out' gaps from strict_m
union all select *, (select count(*) from f5) - test_rows, 'scored' from filled_m""",
)

_MERGED = f"select {fx.COLUMNS_SQL} from base union select {fx.COLUMNS_SQL} from batch"

ORACLES: dict[str, str] = {
    "scan_presplit": _SPLIT_ROWS,
    "scan_full": with_sql("f1k", select="select * from f1k"),
    "write_split_roundtrip": _SPLIT_ROWS,
    "project_features": with_sql("f1", select=f"select {fx.COLUMNS_SQL} from f1"),
    "schema_check": with_sql("f1", "f5", select="\nunion all ".join(
        f"select '{c}' column_name, {'false' if c == 'coolant_temp' else 'true'} present, "
        + ("cast(count(*) * 0 as bigint)" if c == "coolant_temp" else f"count({c})")
        + " rows_with_value from f5"
        for c in (*FEATURES, TARGET)
    )),
    "table_profile": with_sql("f1", select="select count(*) row_count, 7 column_count from f1"),
    "label_distribution": with_sql(
        "f1", select=f"""select {TARGET}, count(*) as rows,
  cast(row_number() over (order by count(*) desc, {TARGET}) as integer) place from f1 group by {TARGET}"""
    ),
    "accepted_rows": with_sql("f1", "f5", select="select * from f5 where " + " and ".join(
        f"{s.name} between {s.low!r} and {s.high!r}" for s in fx.SENSORS
    )),
    "quarantine_rows": with_sql(
        "f1", "f5", f"v as (select *, {VIOLATIONS} violations from f5)",
        select="select * from v where violations <> ''",
    ),
    "quarantine_counts": with_sql("f1", "f5", select=_per_sensor(
        lambda s: f"{s.name} is null",
        lambda s: f"{s.name} is not null and not ({s.name} between {s.low!r} and {s.high!r})",
        ("absent_rows", "outside_rows"),
    )),
    "range_flags": with_sql("f1", "f5", select=f"select *, {UNUSUAL} unusual from f5"),
    "range_flag_counts": with_sql("f1", "f5", select=_per_sensor(
        lambda s: f"{s.name} < {s.seen_low!r}",
        lambda s: f"{s.name} > {s.seen_high!r}",
        ("below_rows", "above_rows"),
    )),
    "fill_defaults": with_sql("f1", "f5", _FILLED, select="select * from filled"),
    "input_summary": with_sql("f1k", select="\nunion all ".join(
        f"""select {fx.KEY}, '{c}' sensor, {c} "value" from f1k""" for c in FEATURES
    )),
    "union_all": with_sql(
        "f1", base_and_batch_sql(), select="select * from base union all select * from batch"
    ),
    "merge_distinct": with_sql("f1", base_and_batch_sql(), select=_MERGED),
    "duplicates_removed": with_sql(
        "f1", base_and_batch_sql(), f"merged as ({_MERGED})",
        select="""select (select count(*) from base) + (select count(*) from batch)
  - (select count(*) from merged) duplicates_removed""",
    ),
    "merge_report": with_sql(
        "f1", base_and_batch_sql(), f"merged as ({_MERGED})",
        "fresh as (select * from batch except select * from base)",
        """sizes as (select (select count(*) from base) b, (select count(*) from batch) a,
    (select count(*) from merged) m, (select count(*) from fresh) f)""",
        select="""select b base_rows, a batch_rows, b + a concat_rows,
  b + a - m duplicates_removed, f new_rows, m merged_rows from sizes""",
    ),
    "merged_label_distribution": with_sql(
        "f1", base_and_batch_sql(), f"merged as ({_MERGED})",
        select=f"""select {TARGET}, count(*) as rows,
  cast(row_number() over (order by count(*) desc, {TARGET}) as integer) place from merged group by {TARGET}""",
    ),
    "new_rows": with_sql(
        "f1", base_and_batch_sql(), select="select * from batch except select * from base"
    ),
    "stream_ingest_merge": with_sql("f1", base_and_batch_sql(), select=_MERGED),
    "stream_ingest_headers": with_sql("f1", select=f"""select distinct {fx.COLUMNS_SQL},
  case when src_key % 3 = 2 then 'u' || (src_key % 7) end as "Unit" from f1"""),
    "stream_ingest_breaks": with_sql("f1", select=f"""select distinct {fx.COLUMNS_SQL},
  case when src_key % 3 = 0 then concat('u', src_key % 7, chr(10), 'said "on",', chr(10), 'end') else 'plain, so' end as "Note" from f1"""),
    "stream_ingest_quarantine": with_sql("f1", select=f"""select distinct {fx.COLUMNS_SQL.replace(
        'engine_rpm', 'case when src_key % 23 <> 0 then engine_rpm end engine_rpm')}
from f1 where {_USABLE}"""),
    "stream_ingest_rejects": with_sql("f1", """reasons as (select *, case
    when src_key % 43 = 0 then 'wrong number of cells'
    else concat_ws('; ',
      case when src_key % 23 <> 0 and src_key % 29 = 0 then 'unreadable engine_rpm' end,
      case when src_key % 31 <> 0 and src_key % 37 <> 0 and src_key % 41 = 0 then 'unreadable engine_condition' end,
      case when src_key % 31 = 0 then 'no engine_condition' end,
      case when src_key % 31 <> 0 and src_key % 37 = 0 then 'engine_condition is not 0 or 1' end) end reason,
    case when src_key % 43 = 0 then 0 when src_key % 31 = 0 then 0 when src_key % 37 = 0 then 1
      when src_key % 41 = 0 then 2 else 3 + engine_condition end label_cell,
    case when src_key % 23 = 0 then -1.0E0 when src_key % 29 = 0 then -2.0E0 else engine_rpm end rpm_cell from f1)""",
        select="""select reason, count(*) as rows, count(distinct concat_ws(',', rpm_cell, lub_oil_pressure,
  fuel_pressure, coolant_pressure, lub_oil_temp, coolant_temp, label_cell)) raws
from reasons where reason <> '' group by reason"""),
    "stream_ingest_archive": with_sql("f1", base_and_batch_sql(), select=_MERGED),
    "evaluate_with_gaps": _GAPS,
    "model_facts": with_sql(*_F1K_SPLIT, select="""select trainer, cast(250 as bigint) n_trees, count(*) scored_rows,
  count(*) chances, 'forced without comparison' first_reason
from parts cross join (values ('gbt'), ('newton')) t(trainer) where split = 'test' group by trainer"""),
    "promote_model": with_sql(*_F1K_SPLIT, select="""select version, kind, 'forced without comparison' reason, n test_rows,
  cast(0 as bigint) unusable_test_rows, cast(0 as bigint) unusable_train_rows, version + 1 data_version
from (values (cast(0 as bigint), 'spark_ml'), (1, 'newton')) t(version, kind)
cross join (select count(*) n from parts where split = 'test')"""),
    "stratified_split": with_sql(
        "ev as (select event_id, user_id, event_type, value from events)",
        split_sql("ev", "event_type", "event_id"),
        select="select * from parts",
    ),
    "stratified_split_readings": _SPLIT_ROWS,
    "split_distribution": with_sql(
        *_F1K_SPLIT, select=f"select split, {TARGET}, count(*) as rows from parts group by 1, 2"
    ),
    "split_leakage": with_sql(
        "f1k", fx.DOUBLED_SQL,
        f"""copies as (select *, {fx.KEY} * 10
    + row_number() over (partition by {fx.KEY} order by {fx.KEY}) copy_key from doubled)""",
        split_sql("copies", TARGET, "copy_key"),
        f"""shared as (select {fx.KEY}, {fx.COLUMNS_SQL}, count(*) n from parts
    group by {fx.KEY}, {fx.COLUMNS_SQL} having min(split) <> max(split))""",
        select="""select cast(count(*) as bigint) shared_rows,
  cast(coalesce(sum(n), 0) as bigint) affected_rows from shared""",
    ),
    "prepare_presplit": _SPLIT_ROWS,
    "prepare_merge": with_sql(
        "f1k", base_and_batch_sql(keyed=True),
        "merged as (select * from base union select * from batch)",
        split_sql("merged", TARGET, fx.KEY),
        select="select * from parts",
    ),
    "prepare_resplit": with_sql(
        "f1k", fx.DOUBLED_SQL, split_sql("doubled", TARGET, fx.KEY),
        select="select * from parts",
    ),
    "confusion_counts": with_sql("f1", _CONFUSION_B, select="select * from conf"),
    "threshold_metrics": with_sql(
        "f1", *_metrics("mb", fx.SCORER_B_SQL),
        select='select accuracy, "precision", recall, f1_score from mb',
    ),
    "roc_auc": with_sql(
        "f1", *_metrics("ma", fx.SCORER_A_SQL), select="select roc_auc from ma"
    ),
    "roc_auc_bucketed": with_sql(
        "f1", *_metrics("mr", "engine_rpm / 1.05E5"), select="select roc_auc from mr"
    ),
    "evaluate_scores": with_sql("f1", *_metrics("ma", fx.SCORER_A_SQL), select=_long("ma")),
    "compare_models": with_sql(*_COMPARISON, select=f"""select metric, existing_value, new_value, diff,
  case when diff > 0 then '✓' when diff < 0 then '✗' else '=' end symbol,
  printf('%.4f', existing_value) existing_text, printf('%.4f', new_value) new_text,
  case when diff >= 0 then '+' else '' end || printf('%.4f', diff) diff_text,
  diff > 0.001E0 improved from compared"""),
    "promotion_decision": with_sql(
        *_COMPARISON, _FLAGS,
        """verdict as (select bool_or(diff > 0.001E0) improved from compared
    union all select bool_or(-diff > 0.001E0) from compared)""",
        """settings as (select improved, trained, has_existing, "compare", "force", data_updated
    from verdict, trained_s, has_existing_s, compare_s, force_s, data_updated_s)""",
        """steps as (select *, "force" or data_updated forces,
    has_existing and "compare" and not data_updated compared from settings)""",
        select="""select improved, trained, has_existing, "compare", "force", data_updated,
  trained and case when compared then improved or forces else forces end publish,
  case when not trained then 'not trained' when compared and improved then 'improved'
    when compared and forces then 'forced without improvement'
    when compared then 'no improvement' when forces then 'forced without comparison'
    else 'not compared' end reason from steps""",
    ),
    "score_batch": with_sql("f1", "f5", _scored("f5", fx.SCORER_C_SQL), select="select * from scored"),
    "score_with_defaults": with_sql(
        "f1", "f5", _FILLED, _scored("filled"), select="select * from scored"
    ),
    "recommendations": with_sql(
        "f1k", _scored("f1k"), _ADVICE,
        select=f"""select s.{fx.KEY}, s.prediction, s.condition, a.line_no, a.status, a.advice
from scored s join advice_lines a on s.prediction = a.prediction""",
    ),
    "stream_score": with_sql("f1k", _scored("f1k"), select="select * from scored"),
    "split_gain": with_sql(*_SPLIT_GAIN, select="select feature, bin, gain from gains"),
    "first_tree": with_sql(
        *_SPLIT_GAIN, _best("root", "gains"),
        """below as (select case when case feature when 'engine_rpm' then b1
    when 'lub_oil_pressure' then b2 else b3 end <= bin then 1 else 2 end node, b1, b2, b3, y
    from binned cross join (select feature, bin from root))""",
        *_gains("child_gains", "below"), _best("children", "child_gains"),
        select="select * from root union all select * from children",
    ),
    "curvature_quantiles": with_sql("f1", """w as (select *, cast(floor(least(1.0E0, engine_rpm/lub_oil_pressure/4.0E3)*1.0E3) as bigint) p from f1)""",
        "u as (" + " union all ".join(f"select '{c}' feature, {c} x, p * (1000 - p) w from w" for c in FEATURES[1:]) + ")",
        """g as (select feature, x, sum(w) w from u where w > 0 group by feature, x),
c as (select feature, x, sum(w) over (partition by feature order by x) upto, sum(w) over (partition by feature) total from g)""",
        select="""select feature, cast(k as int) step, min(x) "value" from c cross join generate_series(1, 15) t(k)
where 16 * upto > k * total group by feature, k"""),
    "stream_score_promoted": with_sql(
        "f1k", _scored("f1k"),
        f"""q as (select {fx.KEY}, accepted, engine_rpm, lub_oil_pressure, cast({fx.KEY} % 2 as bigint) model_version from scored),
p as (select *, 1.0E0 / (1.0E0 + exp(-(0.25E0
    + case when model_version = 0 then case when engine_rpm >= 4.0E4 then 0.75E0 else -0.5E0 end
      else case when engine_rpm >= 4.0E4 then -0.25E0 else 0.5E0 end end
    + case when model_version = 0 then case when lub_oil_pressure >= 25.0E0 then -1.25E0 else 1.0E0 end
      else case when lub_oil_pressure >= 25.0E0 then 0.5E0 else -1.5E0 end end))) chance from q)""",
        select=f"""select {fx.KEY}, model_version, case when accepted then floor(chance * 1.0E3) / 1.0E3 end probability,
  case when accepted then case when chance > 0.5E0 then 1 else 0 end end prediction from p""",
    ),
    "score_tree_model": with_sql(
        "f1",
        """p as (select *, 1.0E0 / (1.0E0 + exp(-(0.25E0
    + case when engine_rpm >= 4.0E4 then 0.75E0 else -0.5E0 end
    + case when lub_oil_pressure >= 25.0E0 then -1.25E0 else 1.0E0 end))) chance from f1)""",
        select="""select * exclude (chance), floor(chance * 1.0E3) / 1.0E3 probability,
  case when chance > 0.5E0 then 1 else 0 end prediction from p""",
    ),
}
ORACLES["new_rows_distinct_base"] = ORACLES["new_rows"]
ORACLES["stream_ingest_incremental"] = ORACLES["stream_ingest_merge"]
ORACLES["new_rows_large_batch"] = ORACLES["new_rows"]
ORACLES["stream_ingest_segments"] = ORACLES["stream_ingest_merge"]
