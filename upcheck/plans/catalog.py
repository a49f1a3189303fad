"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads whole tables under ``sf_dir`` (through a fixture derived
from them) and runs library operators; array results are joined into one
string so that both engines produce comparable values.  Each oracle is plain
SQL over the same tables, written independently of the Spark code path
(``NOT EXISTS`` instead of anti joins, CTEs instead of operators).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upcheck.functions.text import extract_int
from upcheck.operators import delta
from upcheck.operators.audit import audit_sample, empty_audit, key_fields, lookup_audit, summarize_audit, union_audit, unknown_id_report
from upcheck.operators.bloom import filtered_mismatches
from upcheck.operators.columns import check_schema, drop_all_null, normalise_columns, schema_report
from upcheck.operators.columnwise import column_mismatches
from upcheck.operators.reconcile import (ReconcileSpec, align_authority, conflict_audit,
                                         exact_mismatches, reconcile, residual, unknown_ids)
from upcheck.operators.rowwise import unmatched_rows
from upcheck.operators.validate import TokenRule, clean_tokens, validate_tokens
from upcheck.plans import fixtures as fx
from upcheck.plans.presets import UploadPreset, sequence_columns
from upcheck.plans.stream_demo import FILES, holds_oracle, ingest_oracle, run_holds, run_ingest, run_job
from upcheck.plans.upload_job import audit_as_text, process_upload
from upcheck.session import scratch_path
from upcheck.sources.csv import read_upload_csv, write_csv

SUB_SPEC = ReconcileSpec("id", ("sequence_id", "run", "antigen"),
                         "sample_id", ("alias", "run", "antigen"))
DUP_SPEC = ReconcileSpec("id", ("ln", "rf", "ls"), "id", ("ln", "rf", "ls"))
SEQ_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEQ_KEYS = ("id", "ln")
AB_PRESET = UploadPreset()


def _sub(spark, sf_dir):
    return fx.spark_fixture(spark, sf_dir, fx.SUB), fx.spark_fixture(spark, sf_dir, fx.AUTH)


def _seq_rule(allow_null: bool) -> TokenRule:
    return TokenRule(("s1", "s2"), SEQ_ALPHABET, allow_null)


# --------------------------------------------------------------------------- queries

def q_extract_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = fx.spark_fixture(spark, sf_dir, fx.RUNS)
    return runs.select("src", "raw", extract_int("raw").alias("run"))


def q_normalise_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fx.table(spark, sf_dir, "part")
    odd = part.select(*[F.col(c).alias(n) for c, n in fx.PART_ODD_NAMES.items()])
    return normalise_columns(odd)


def q_drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_all_null(fx.spark_fixture(spark, sf_dir, fx.SPARSE))


def q_schema_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.spark_fixture(spark, sf_dir, fx.ORDERS_CSV)
    upload = normalise_columns(orders.toDF(*[fx.ORDERS_CSV_HEADERS[c] for c in orders.columns]))
    target = ["order_key", "cust_key", "order_status", "total_price", "source_key"]
    chk = check_schema(upload, target)
    return upload.select(*chk.matched, *chk.extra)


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.spark_fixture(spark, sf_dir, fx.ORDERS_CSV)
    odd = orders.toDF(*[fx.ORDERS_CSV_HEADERS[c] for c in orders.columns])
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(odd, path)
    back = read_upload_csv(spark, path, prepare=normalise_columns)
    return back.select(F.col("order_key").cast("bigint").alias("order_key"),
                       F.col("cust_key").cast("bigint").alias("cust_key"),
                       "order_status",
                       F.col("total_price").cast("double").alias("total_price"),
                       "st1_date", "order_priority", "note")


def q_exact_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return exact_mismatches(sub, align_authority(auth, SUB_SPEC, sub), SUB_SPEC.keys)


def q_unknown_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return unknown_ids(sub, align_authority(auth, SUB_SPEC, sub), "id")


def q_conflict_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return audit_as_text(conflict_audit(sub, auth, SUB_SPEC))


def q_conflict_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return summarize_audit(reconcile(sub, auth, SUB_SPEC).audit)


def q_audit_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return audit_as_text(lookup_audit(reconcile(sub, auth, SUB_SPEC).audit, "id", "X11"))


def q_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return reconcile(sub, auth, SUB_SPEC).clean


def q_reconciled_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return audit_as_text(reconcile(sub, auth, SUB_SPEC).audit)


def q_reconciled_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = fx.spark_fixture(spark, sf_dir, fx.DUP_UPLOAD)
    auth = fx.spark_fixture(spark, sf_dir, fx.DUP_AUTH)
    return reconcile(up, auth, DUP_SPEC).clean


def q_reconciled_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bag form, by id: an id's rows, its authority's rows and its conflicts multiplied."""
    up = fx.spark_fixture(spark, sf_dir, fx.DUP_UPLOAD)
    auth = fx.spark_fixture(spark, sf_dir, fx.DUP_AUTH)
    clean = reconcile(up, auth, DUP_SPEC, dedupe_ids=False).clean
    return clean.groupBy("id").agg(F.count("*").alias("n_rows"), F.sum("pay").alias("pay"), F.sum("ln").alias("ln"), F.count("ls").alias("n_ls"))


def _updated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, delta.Kept, delta.Update]:
    """Rows and tables of a run against the first authority, and what the later one changes."""
    sub, auth = _sub(spark, sf_dir)
    kept = delta.keep(sub, auth, SUB_SPEC)
    return sub, kept, delta.update(sub, kept, fx.spark_fixture(spark, sf_dir, fx.AUTH_LATER), SUB_SPEC)


def q_authority_update_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows against a later authority: those of the run before, and anew for the ids that changed."""
    sub, kept, change = _updated(spark, sf_dir)
    return delta.replace_ids(delta.clean_rows(sub, kept, SUB_SPEC), change.clean, change.ids, "id")


def q_authority_update_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit against a later authority, from the updated tables."""
    return audit_as_text(_updated(spark, sf_dir)[2].kept.found.audit(SUB_SPEC))


def q_audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return audit_sample(reconcile(sub, auth, SUB_SPEC).audit, "id").select("conflict_columns", "resolved", F.array_join("ids", ",").alias("ids"))


def q_whole_row_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload rows that no authority row equals in all columns; rows with a null and copies stay."""
    up = fx.spark_fixture(spark, sf_dir, fx.DUP_UPLOAD).drop("pay")
    return unmatched_rows(up.unionAll(up.where("ln % 2 = 0")), fx.spark_fixture(spark, sf_dir, fx.DUP_AUTH))


def q_filtered_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows against all line tuples, most of which a filter drops before they are shuffled."""
    return filtered_mismatches(fx.spark_fixture(spark, sf_dir, fx.FIRST_LINES), fx.spark_fixture(spark, sf_dir, fx.DUP_AUTH), DUP_SPEC.keys)


def q_column_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload rows whose run their id does not have in the authority."""
    sub, auth = _sub(spark, sf_dir)
    return column_mismatches(sub, align_authority(auth, SUB_SPEC, sub), SUB_SPEC, "run")


def q_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    clean = reconcile(sub, auth, SUB_SPEC).clean
    return residual(clean, auth, SUB_SPEC).agg(F.count(F.lit(1)).alias("residual_rows"))


def q_clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_tokens(fx.spark_fixture(spark, sf_dir, fx.SEQ), ["s1", "s2"])


def _seq_validate(spark, sf_dir, allow_null):
    seq = fx.spark_fixture(spark, sf_dir, fx.SEQ)
    return validate_tokens(seq, None, _seq_rule(allow_null), "id", SEQ_KEYS)


def q_seq_audit_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_as_text(_seq_validate(spark, sf_dir, False)[1])


def q_seq_audit_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_as_text(_seq_validate(spark, sf_dir, True)[1])


def q_quarantine_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seq_validate(spark, sf_dir, False)[0]


def q_quarantine_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seq_validate(spark, sf_dir, True)[0]


def ab_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The antibody-shaped upload under exported-style headers, and its authority."""
    up = fx.spark_fixture(spark, sf_dir, fx.AB_UPLOAD)
    up = up.toDF(*[fx.ab_header(c) for c in up.columns])
    return up, fx.spark_fixture(spark, sf_dir, fx.AB_AUTH)


def q_upload_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    up, auth = ab_inputs(spark, sf_dir)
    return process_upload(up, auth, AB_PRESET).clean


def q_upload_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    up, auth = ab_inputs(spark, sf_dir)
    return audit_as_text(process_upload(up, auth, AB_PRESET).audit)


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_ingest(spark, sf_dir)


def q_stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(spark, sf_dir)[0]


def q_stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(spark, sf_dir)[1]


def q_stream_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids at fault in one upload, held over later ones until a fix."""
    return run_holds(spark, sf_dir)


def q_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV sink: joined lists, hostile values, white space kept."""
    orders = fx.spark_fixture(spark, sf_dir, fx.ORDERS_CSV)
    path = scratch_path(spark, "csv_sink")
    write_csv(orders.select(F.col("order_key").alias("Order. Key"), F.array("order_status", "order_priority").alias("marks"), "note"), path)
    return read_upload_csv(spark, path, prepare=normalise_columns).select(F.col("order_key").cast("bigint").alias("order_key"), "marks", "note")


_REPORT_TARGET = ["order_key", "cust_key", "total_price", "clerk", "source_key"]


def q_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's report, beside the number of values in the upload's columns."""
    orders = fx.spark_fixture(spark, sf_dir, fx.ORDERS_CSV)
    upload = normalise_columns(orders.toDF(*[fx.ORDERS_CSV_HEADERS[c] for c in orders.columns]))
    counts = upload.agg(*[F.count(c).alias(c) for c in upload.columns]).unpivot([], list(upload.columns), "column_name", "n_values")
    return schema_report(spark, upload, _REPORT_TARGET).join(counts, "column_name", "left")


def q_audit_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits of several checks in one table, an empty one among them."""
    sub, auth = _sub(spark, sf_dir)
    audit = reconcile(sub, auth, SUB_SPEC).audit
    none = empty_audit(spark, key_fields(sub, SUB_SPEC.keys))
    return audit_as_text(union_audit(none, audit, none, audit.where("resolved = 'no'")))


def q_unknown_id_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, auth = _sub(spark, sf_dir)
    return unknown_id_report(unknown_ids(sub, align_authority(auth, SUB_SPEC, sub), "id"), "id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_extract_int": q_extract_int,
    "q_normalise_columns": q_normalise_columns,
    "q_drop_all_null": q_drop_all_null,
    "q_schema_gate": q_schema_gate,
    "q_csv_roundtrip": q_csv_roundtrip,
    "q_exact_mismatch": q_exact_mismatch,
    "q_unknown_ids": q_unknown_ids,
    "q_conflict_audit": q_conflict_audit,
    "q_conflict_summary": q_conflict_summary,
    "q_audit_lookup": q_audit_lookup,
    "q_reconciled": q_reconciled,
    "q_reconciled_audit": q_reconciled_audit,
    "q_reconciled_dup": q_reconciled_dup,
    "q_reconciled_bag": q_reconciled_bag,
    "q_whole_row_anti": q_whole_row_anti,
    "q_authority_update_clean": q_authority_update_clean,
    "q_authority_update_audit": q_authority_update_audit,
    "q_audit_sample": q_audit_sample,
    "q_filtered_mismatch": q_filtered_mismatch,
    "q_column_mismatch": q_column_mismatch,
    "q_residual": q_residual,
    "q_clean_tokens": q_clean_tokens,
    "q_seq_audit_strict": q_seq_audit_strict,
    "q_seq_audit_nullable": q_seq_audit_nullable,
    "q_quarantine_strict": q_quarantine_strict,
    "q_quarantine_nullable": q_quarantine_nullable,
    "q_upload_clean": q_upload_clean,
    "q_upload_audit": q_upload_audit,
    "q_stream_ingest": q_stream_ingest,
    "q_stream_clean": q_stream_clean,
    "q_stream_audit": q_stream_audit,
    "q_stream_holds": q_stream_holds,
    "q_csv_sink": q_csv_sink,
    "q_schema_report": q_schema_report,
    "q_audit_union": q_audit_union,
    "q_unknown_id_report": q_unknown_id_report,
}


# --------------------------------------------------------------------------- oracle SQL

def _int_sql(expr: str) -> str:
    digits = f"regexp_replace({expr}, '[A-Za-z]', '', 'g')"
    return (f"case when regexp_full_match({digits}, '[+-]?[0-9]+') "
            f"then try_cast({digits} as bigint) end")


def _reconcile_ctes(up: str, auth: str, id_: str, attrs: list[str], auth_id: str,
                    auth_attrs: list[str]) -> str:
    """CTEs ``rc_conf`` (distinct conflicting ids with known flag) and
    ``rc_clean`` (reconciled rows) over CTEs/views named ``up`` and ``auth``."""
    match = " and ".join([f"a.{auth_id} = u.{id_}"] +
                         [f"a.{aa} = u.{ua}" for ua, aa in zip(attrs, auth_attrs)])
    return f"""
rc_mis as (select u.* from {up} u where not exists (select 1 from {auth} a where {match})),
rc_ids as (select distinct {id_} as cid from rc_mis where {id_} is not null),
rc_known as (select cid from rc_ids where exists (select 1 from {auth} a where a.{auth_id} = rc_ids.cid))"""


def _oracle_reconciled_rows(up: str, auth: str, id_: str, attrs: list[str], auth_id: str,
                            auth_attrs: list[str], payload: list[str], out_cols: list[str]) -> str:
    """SELECT producing reconciled rows in ``out_cols`` order (needs _reconcile_ctes)."""
    keep_cols = ", ".join(out_cols)
    fix_cols = []
    amap = dict(zip(attrs, auth_attrs))
    for c in out_cols:
        if c == id_:
            fix_cols.append(f"u.{id_} as {id_}")
        elif c in amap:
            fix_cols.append(f"a.{amap[c]} as {c}")
        else:
            fix_cols.append(f"u.{c} as {c}")
    return f"""
select {keep_cols} from {up} where {id_} is null or {id_} not in (select cid from rc_ids)
union all
select {", ".join(fix_cols)}
from {up} u join rc_known k on u.{id_} = k.cid join {auth} a on a.{auth_id} = k.cid"""


def _oracle_conflict_lists(mis: str, auth: str, id_: str, attrs: list[str], auth_id: str,
                           auth_attrs: list[str]) -> str:
    """CTE bodies: per-row flags -> per-id conflict list ``cl(cid, conflict_columns, resolved)``."""
    row_flags = ",\n       ".join(
        f"not exists (select 1 from {auth} a where a.{auth_id} = m.{id_} and a.{aa} = m.{ua}) as f_{ua}"
        for ua, aa in zip(attrs, auth_attrs))
    anynull = " or ".join(f"m.{c} is null" for c in [id_, *attrs])
    per_id_flags = ", ".join(f"bool_or(f_{c}) as f_{c}" for c in attrs)
    unk_list = ", ".join([f"'{id_}'"] + [f"case when anynull then '{c}' end" for c in attrs])
    known_list = ", ".join(f"case when f_{c} then '{c}' end" for c in attrs)
    return f"""
cf as (select m.{id_} as cid,
       not exists (select 1 from {auth} a where a.{auth_id} = m.{id_}) as unk,
       ({anynull}) as anynull,
       {row_flags}
       from {mis} m),
pid as (select cid, bool_or(unk) as unk, bool_or(anynull) as anynull, {per_id_flags}
        from cf group by cid),
cl as (select cid,
       case when unk then concat_ws(',', {unk_list}) else concat_ws(',', {known_list}) end
         as conflict_columns,
       case when unk then 'no' else 'yes' end as resolved
       from pid)"""


def _sub_ctes(more: bool = True, authority: str = fx.AUTH) -> str:
    return (f"with up as ({fx.duck_fixture(fx.SUB)}),\n"
            f"auth as ({fx.duck_fixture(authority)})" + ("," if more else "\n"))


_SUB_ATTRS = ["sequence_id", "run", "antigen"]
_SUB_AUTH_ATTRS = ["alias", "run", "antigen"]


def _sub_audit_sql(authority: str = fx.AUTH) -> str:
    return (_sub_ctes(authority=authority)
            + _reconcile_ctes("up", "auth", "id", _SUB_ATTRS, "sample_id", _SUB_AUTH_ATTRS) + ","
            + _oracle_conflict_lists("rc_mis", "auth", "id", _SUB_ATTRS, "sample_id",
                                     _SUB_AUTH_ATTRS)
            + """
select m.id, m.sequence_id, m.run, m.antigen, cl.conflict_columns, cl.resolved
from rc_mis m join cl on m.id = cl.cid
where cl.conflict_columns <> ''""")


def _sub_clean_sql(authority: str = fx.AUTH) -> str:
    return (_sub_ctes(authority=authority)
            + _reconcile_ctes("up", "auth", "id", _SUB_ATTRS, "sample_id", _SUB_AUTH_ATTRS)
            + _oracle_reconciled_rows("up", "auth", "id", _SUB_ATTRS, "sample_id",
                                      _SUB_AUTH_ATTRS, ["pay"],
                                      ["id", "sequence_id", "run", "antigen", "pay"]))


def _invalid_sql(col: str, alphabet: str, allow_null: bool) -> str:
    valid = f"regexp_full_match(upper(trim({col})), '[{alphabet}]+')"
    if allow_null:
        return f"({col} is not null and not {valid})"
    return f"({col} is null or not {valid})"


def _inv_list_sql(cols, alphabet: str, allow_null: bool) -> str:
    parts = ", ".join(f"case when {_invalid_sql(c, alphabet, allow_null)} then '{c}' end" for c in cols)
    return f"nullif(concat_ws(',', {parts}), '')"


def _seq_oracles(allow_null: bool) -> tuple[str, str]:
    inv = _inv_list_sql(["s1", "s2"], SEQ_ALPHABET, allow_null)
    base = f"""with seq as ({fx.duck_fixture(fx.SEQ)}),
fl as (select *, {inv} as cc from seq),
bad as (select distinct id from fl where cc is not null and id is not null)"""
    audit = base + "\nselect id, ln, cc as conflict_columns, 'no' as resolved from fl where cc is not null"
    clean = base + "\nselect id, ln, s1, s2 from seq where id is null or id not in (select id from bad)"
    return audit, clean


def _ab_oracles(only: str = "true") -> tuple[str, str]:
    """Clean rows and audit of the upload's rows that ``only`` holds for."""
    p = AB_PRESET
    aa, nu = list(sequence_columns("aa")), list(sequence_columns("nu"))
    up_cols = ["mab_id", "sequence_id", "run", "antigen", "line_number", *aa, *nu]
    up_select = ", ".join(_int_sql("run") + " as run" if c == "run" else c for c in up_cols)
    attrs = [p.sequence_col, p.run_col, p.antigen_col]
    auth_attrs = [p.authority_sequence, p.authority_run, p.authority_antigen]
    rules = p.rules
    aa_inv = _inv_list_sql(aa, rules[0].alphabet, rules[0].allow_null)
    nu_inv = _inv_list_sql(nu, rules[1].alphabet, rules[1].allow_null)
    cleaned = ", ".join(f"upper(trim({c})) as {c}" if c in aa or c in nu else c for c in up_cols)
    ctes = (f"with raw as (select * from ({fx.duck_fixture(fx.AB_UPLOAD)}) u0 where {only}),\n"
            f"up as (select {up_select} from raw),\n"
            f"auth as (select sample_id, alias, {_int_sql('run')} as run, antigen "
            f"from ({fx.duck_fixture(fx.AB_AUTH)}) a0),"
            + _reconcile_ctes("up", "auth", p.id_col, attrs, p.authority_id, auth_attrs) + ",\n"
            + "rec as (" + _oracle_reconciled_rows("up", "auth", p.id_col, attrs, p.authority_id,
                                                    auth_attrs, [], up_cols) + "),\n"
            + f"fl as (select *, {aa_inv} as aa_cc, {nu_inv} as nu_cc from rec),\n"
            + "bad_aa as (select distinct mab_id from fl where aa_cc is not null and mab_id is not null),\n"
            + "surv as (select * from fl where mab_id is null or mab_id not in (select mab_id from bad_aa)),\n"
            + "bad_nu as (select distinct mab_id from surv where nu_cc is not null and mab_id is not null),"
            + _oracle_conflict_lists("rc_mis", "auth", p.id_col, attrs, p.authority_id, auth_attrs))
    clean = ctes + f"""
select {cleaned} from surv where mab_id is null or mab_id not in (select mab_id from bad_nu)"""
    audit = ctes + """
select m.mab_id, m.sequence_id, m.run, m.antigen, cl.conflict_columns, cl.resolved
from rc_mis m join cl on m.mab_id = cl.cid where cl.conflict_columns <> ''
union all
select mab_id, sequence_id, run, antigen, aa_cc, 'no' from fl where aa_cc is not null
union all
select mab_id, sequence_id, run, antigen, nu_cc, 'no' from surv where nu_cc is not null"""
    return clean, audit


def _stream_job_oracles() -> tuple[str, str]:
    """The job's oracles, file by file."""
    parts = [_ab_oracles(f"cast(line_number as integer) % {FILES} = {f}") for f in range(FILES)]
    return tuple("\nunion all\n".join(f"select * from ({p[i]}) f{n}" for n, p in enumerate(parts)) for i in (0, 1))


def _schema_report_sql() -> str:
    target, optional = _REPORT_TARGET, ["source_key"]
    names = {**{c: c for c in fx.ORDERS_CSV_HEADERS}, "first_date": "st1_date"}
    rows = [(n, "matched" if n in target else "extra", f"count({c})") for c, n in names.items()]
    rows += [(c, "optional_missing" if c in optional else "missing", "max(cast(null as bigint))") for c in target if c not in names.values()]
    source = fx.duck_fixture(fx.ORDERS_CSV)
    return "\nunion all\n".join(f"select '{n}' as column_name, '{status}' as status, {count} as n_values from ({source}) o" for n, status, count in rows)


def oracle_sql() -> dict[str, str]:
    seq_audit_strict, seq_clean_strict = _seq_oracles(False)
    seq_audit_null, seq_clean_null = _seq_oracles(True)
    ab_clean, ab_audit = _ab_oracles()
    stream_clean, stream_audit = _stream_job_oracles()
    runs = fx.duck_fixture(fx.RUNS)
    part_cols = ", ".join(f"{c} as {n}" for c, n in fx.PART_CLEAN_NAMES.items())
    orders_csv = fx.duck_fixture(fx.ORDERS_CSV)
    sub_audit = _sub_audit_sql()
    sub_clean = _sub_clean_sql()
    return {
        "q_extract_int": f"select src, raw, {_int_sql('raw')} as run from ({runs}) r",
        "q_normalise_columns": f"select {part_cols} from part",
        "q_drop_all_null": (f"select * from ({fx.duck_fixture(fx.SPARSE)}) s "
                            "where not (c1 is null and c2 is null and c3 is null and c4 is null)"),
        "q_schema_gate": (f"select order_key, cust_key, order_status, total_price, "
                          f"first_date as st1_date, order_priority, note from ({orders_csv}) o"),
        "q_csv_roundtrip": (f"select order_key, cust_key, order_status, total_price, "
                            f"first_date as st1_date, "
                            f"order_priority, note from ({orders_csv}) o"),
        "q_exact_mismatch": (_sub_ctes(False) +
                             "select u.id, u.sequence_id, u.run, u.antigen from up u where not exists "
                             "(select 1 from auth a where a.sample_id = u.id and a.alias = u.sequence_id "
                             "and a.run = u.run and a.antigen = u.antigen)"),
        "q_unknown_ids": (_sub_ctes(False) +
                          "select distinct u.id from up u where not exists "
                          "(select 1 from auth a where a.sample_id = u.id)"),
        "q_conflict_audit": sub_audit,
        "q_conflict_summary": (f"select conflict_columns, resolved, count(*) as n_rows from ({sub_audit}) t "
                               "group by conflict_columns, resolved"),
        "q_audit_lookup": f"select * from ({sub_audit}) t where id = 'X11'",
        "q_reconciled": sub_clean,
        "q_reconciled_audit": sub_audit,
        "q_reconciled_dup": (f"with up as ({fx.duck_fixture(fx.DUP_UPLOAD)}),\n"
                             f"auth as ({fx.duck_fixture(fx.DUP_AUTH)}),"
                             + _reconcile_ctes("up", "auth", "id", ["ln", "rf", "ls"], "id",
                                               ["ln", "rf", "ls"])
                             + _oracle_reconciled_rows("up", "auth", "id", ["ln", "rf", "ls"], "id",
                                                       ["ln", "rf", "ls"], ["pay"],
                                                       ["id", "ln", "rf", "ls", "pay"])),
        "q_reconciled_bag": f"""
with up as ({fx.duck_fixture(fx.DUP_UPLOAD)}), auth as ({fx.duck_fixture(fx.DUP_AUTH)}),
mis as (select id, count(*) as k from up u where not exists
        (select 1 from auth a where a.id = u.id and a.ln = u.ln and a.rf = u.rf and a.ls = u.ls) group by id),
a as (select id, count(*) as m, sum(ln) as ln, count(ls) as n_ls from auth group by id),
n as (select id, count(*) as n, sum(pay) as pay, sum(ln) as ln, count(ls) as n_ls from up group by id)
select n.id, cast(case when k is null then n.n else n.n * a.m * k end as bigint) as n_rows,
       cast(case when k is null then n.pay else n.pay * a.m * k end as bigint) as pay,
       cast(case when k is null then n.ln else a.ln * n.n * k end as bigint) as ln,
       cast(case when k is null then n.n_ls else a.n_ls * n.n * k end as bigint) as n_ls
from n left join mis on mis.id = n.id left join a on a.id = n.id""",
        "q_whole_row_anti": f"""
with up as (select id, ln, rf, ls from ({fx.duck_fixture(fx.DUP_UPLOAD)}) u0), auth as ({fx.duck_fixture(fx.DUP_AUTH)}),
twice as (select * from up union all select * from up where ln % 2 = 0)
select * from twice u where not exists (select 1 from auth a where a.id = u.id and a.ln = u.ln and a.rf = u.rf and a.ls = u.ls)""",
        "q_authority_update_clean": _sub_clean_sql(fx.AUTH_LATER),
        "q_authority_update_audit": _sub_audit_sql(fx.AUTH_LATER),
        "q_audit_sample": (f"select conflict_columns, resolved, string_agg(id, ',' order by md5(id), id) as ids from "
                           f"(select * from (select distinct conflict_columns, resolved, id from ({sub_audit}) t) "
                           "qualify row_number() over (partition by conflict_columns, resolved order by md5(id), id) <= 20) group by conflict_columns, resolved"),
        "q_filtered_mismatch": f"""
with up as ({fx.duck_fixture(fx.FIRST_LINES)}), auth as ({fx.duck_fixture(fx.DUP_AUTH)})
select * from up u where not exists (select 1 from auth a where a.id = u.id and a.ln = u.ln and a.rf = u.rf and a.ls = u.ls)""",
        "q_column_mismatch": (_sub_ctes(False) + "select u.* from up u where not exists "
                              "(select 1 from auth a where a.sample_id = u.id and a.run = u.run)"),
        "q_residual": (_sub_ctes() + _reconcile_ctes("up", "auth", "id", _SUB_ATTRS, "sample_id",
                                                     _SUB_AUTH_ATTRS)
                       + ",\nrc as (" + _oracle_reconciled_rows("up", "auth", "id", _SUB_ATTRS,
                                                                 "sample_id", _SUB_AUTH_ATTRS, ["pay"],
                                                                 ["id", "sequence_id", "run",
                                                                  "antigen", "pay"]) + ")\n"
                       "select count(*) as residual_rows from rc u where not exists "
                       "(select 1 from auth a where a.sample_id = u.id and a.alias = u.sequence_id "
                       "and a.run = u.run and a.antigen = u.antigen)"),
        "q_clean_tokens": (f"select id, ln, upper(trim(s1)) as s1, upper(trim(s2)) as s2 "
                           f"from ({fx.duck_fixture(fx.SEQ)}) s"),
        "q_seq_audit_strict": seq_audit_strict,
        "q_seq_audit_nullable": seq_audit_null,
        "q_quarantine_strict": seq_clean_strict,
        "q_quarantine_nullable": seq_clean_null,
        "q_upload_clean": ab_clean,
        "q_upload_audit": ab_audit,
        "q_stream_ingest": ingest_oracle(_int_sql),
        "q_stream_clean": stream_clean,
        "q_stream_audit": stream_audit,
        "q_stream_holds": holds_oracle(_invalid_sql),
        "q_csv_sink": f"select order_key, concat(order_status, ';', order_priority) as marks, note from ({orders_csv}) o",
        "q_schema_report": _schema_report_sql(),
        "q_audit_union": f"with a as ({sub_audit}) select * from a union all select * from a where resolved = 'no'",
        "q_unknown_id_report": (_sub_ctes(False) + "select id, count(*) over () as n_unknown from (select distinct u.id from up u where u.id is not null "
                                "and not exists (select 1 from auth a where a.sample_id = u.id)) x order by id limit 20"),
    }
