"""Every registered query with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagwright.engine import LabelEngine
from tagwright.functions.tags import TAGS, with_complete_tags
from tagwright.operators import batching, labels as label_ops, ledger, quality, stats
from tagwright.operators.labels import LABEL_COLUMNS
from tagwright.plans.oracle import sql
from tagwright.plans.sample import BATCH_SIZE, Sample
from tagwright.sources import files

START = "2024-02-01 00:00:00"
DELAY_SECONDS = 1.0
PAGE = (500, 1_000)  # rows, offset
DEEP_PAGE = (500, 20_000)
PREVIEW_ROWS = 100
DELIVERED = ("already_sent", "valid", "result_status")  # what tells how a label fared

LABEL_LIST = ", ".join(LABEL_COLUMNS)
TAG_LIST = ", ".join(TAGS)


@dataclass(frozen=True)
class Query:
    build: Callable[[Sample], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Sample(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(oracle: str | None):
    """Register a query under its function name."""

    def add(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
        REGISTRY[build.__name__] = Query(build, None if oracle is None else sql(oracle))
        return build

    return add


# A deployment that a third of the facts are given in ``skewed_label_rows``, and
# the rows of one key from which on they are spread there.
HOT_DEPLOYMENT, HOT_ROWS_PER_SLOT = 1, 1_000


# -- tables and joins -----------------------------------------------------------

COUNT_UNION = " union all ".join(
    f"select '{t}' as table_name, count(*) as n_rows, count(*) = 0 as is_empty from {t}"
    for t in ("verified_contracts", "contract_deployments", "compiled_contracts")
)


@query(COUNT_UNION)
def table_counts(s: Sample) -> DataFrame:
    return s.engine.table_counts()


@query(f"select count(*) filter (where is_empty) > 0 as any_empty from ({COUNT_UNION})")
def empty_tables(s: Sample) -> DataFrame:
    return s.engine.table_counts().agg((F.count_if("is_empty") > 0).alias("any_empty"))


@query("select * from totals")
def join_match_counts(s: Sample) -> DataFrame:
    return s.engine.join_match_counts()


@query(
    "select *, full_join = 0 as no_match, "
    "full_join < cast(least(vc_to_deployments, vc_to_compiled) as double) * 0.8::double "
    "as low_match from totals"
)
def join_health(s: Sample) -> DataFrame:
    return s.engine.join_health()


@query(
    """
    select chain_id, count(*) as contract_count
    from facts join (select id as deployment_id, chain_id from contract_deployments)
      using (deployment_id)
    group by chain_id having chain_id is not null order by 2 desc, 1 limit 20"""
)
def chain_distribution(s: Sample) -> DataFrame:
    return s.engine.chain_distribution()


@query(
    """
    select code_language as language, count(*) as contract_count
    from facts join built using (compilation_id) group by code_language"""
)
def language_distribution(s: Sample) -> DataFrame:
    return s.engine.language_distribution()


_PARTS = {
    "with_deployment_tx": "deployment_tx is not null",
    "with_deployment_block": "deployment_block is not null",
    "with_deployer_address": "deployer_address is not null",
    "with_code_language": "language is not null",
    "with_code_compiler": "language is not null and version is not null",
}


@query(
    "select total_contracts, "
    + ", ".join(
        f"{p}, case when total_contracts > 0 then cast({p} as double) / total_contracts * 100 "
        f"else 0 end as {p}_pct"
        for p in _PARTS
    )
    + " from (select count(*) as total_contracts, "
    + ", ".join(f"count(*) filter (where {rule}) as {p}" for p, rule in _PARTS.items())
    + """ from facts join placed using (deployment_id)
          join (select id as compilation_id, language, version from compiled_contracts)
            using (compilation_id))"""
)
def completeness(s: Sample) -> DataFrame:
    return s.engine.completeness()


# -- labels -----------------------------------------------------------------------


@query("select * from label_rows")
def label_rows(s: Sample) -> DataFrame:
    return s.labels


@query(
    f"""
    select id as verified_contract_id, address, chain_id, code_language
    from (select id, compilation_id,
                 case when id % 3 = 0 then {HOT_DEPLOYMENT} else deployment_id end as deployment_id
          from facts)
    join placed using (deployment_id) join built using (compilation_id)
    where address <> '0x' || repeat('0', 40)"""
)
def skewed_label_rows(s: Sample) -> DataFrame:
    """Labels when one deployment holds a third of all rows, spread over tasks."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(HOT_DEPLOYMENT)).otherwise(F.col("deployment_id"))
    tables = {**s.engine.tables, "verified_contracts": s.verified.withColumn("deployment_id", hot)}
    engine = LabelEngine(tables, s.engine.verifier, rows_per_slot=HOT_ROWS_PER_SLOT)
    return engine.labels().select("verified_contract_id", "address", "chain_id", "code_language")


@query("select * from label_rows_all")
def label_rows_with_zero_address(s: Sample) -> DataFrame:
    return label_ops.label_rows(
        s.verified, s.deployments, s.compilations, s.engine.verifier, drop_zero_address=False
    )


@query(f"select * from label_rows order by verified_contract_id limit {PAGE[0]} offset {PAGE[1]}")
def label_page(s: Sample) -> DataFrame:
    return s.engine.page(*PAGE)


@query(
    f"select * from label_rows order by verified_contract_id "
    f"limit {DEEP_PAGE[0]} offset {DEEP_PAGE[1]}"
)
def label_deep_page(s: Sample) -> DataFrame:
    return label_ops.deep_label_page(s.labels, *DEEP_PAGE)


_PREVIEW_COLUMNS = (
    "verified_contract_id, address, chain_id, cast(verified_at as varchar) as verified_at, "
    + TAG_LIST
)


@query(
    f"""
    , sample as (select {_PREVIEW_COLUMNS} from label_rows
                 order by verified_contract_id limit {PREVIEW_ROWS})
    select (select count(*) from sample) as sample_count, * from sample"""
)
def label_preview(s: Sample) -> DataFrame:
    rows = s.engine.preview(PREVIEW_ROWS).select("sample_count", F.inline("contracts"))
    return rows.select(
        "sample_count", "verified_contract_id", "address", "chain_id", "verified_at", "tags.*"
    )


@query(
    """
    select * exclude (rn) from (
      select *, row_number() over (partition by lower(address), chain_id
                                   order by verified_contract_id) as rn from label_rows)
    where rn = 1"""
)
def one_per_key(s: Sample) -> DataFrame:
    return label_ops.one_per_key(s.labels)


# -- tags and validation --------------------------------------------------------


@query(f"select verified_contract_id, {TAG_LIST}, tag_count from counted")
def prepared_tags(s: Sample) -> DataFrame:
    return s.engine.prepared().select("verified_contract_id", "tags.*", "tag_count")


@query("select tag_count, count(*) as n_labels from counted group by tag_count")
def prepared_tag_counts(s: Sample) -> DataFrame:
    return stats.complete_tag_distribution(s.engine.prepared(), "tag_count")


@query(
    "select verified_contract_id, address, chain_ref, tag_count, "
    "invalid_reason is null as valid, invalid_reason from verdicts"
)
def validation(s: Sample) -> DataFrame:
    return s.engine.prepared().select(
        "verified_contract_id", "address", "chain_ref", "tag_count", "valid", "invalid_reason"
    )


_FILLED = " + ".join(f"cast({t} is not null as integer)" for t in TAGS)


@query(
    f"select {_FILLED} as complete_tags, count(*) as n_labels from label_rows "
    f"group by complete_tags"
)
def complete_tag_counts(s: Sample) -> DataFrame:
    return stats.complete_tag_distribution(with_complete_tags(s.labels), "complete_tags")


# -- label sets and quality -------------------------------------------------------


@query(
    """
    select count(*) as total_contracts, count(distinct chain_id) as unique_chains,
           count(deployment_tx) as contracts_with_deployment_tx,
           count(deployment_block) as contracts_with_deployment_block,
           count(deployer_address) as contracts_with_deployer,
           count(code_language) as contracts_with_language,
           count(code_compiler) as contracts_with_compiler
    from label_rows"""
)
def label_set_stats(s: Sample) -> DataFrame:
    return stats.label_set_stats(s.labels)


@query(
    """
    select chain_id, count(*) as contract_count from label_rows group by chain_id
    order by contract_count desc, chain_id limit 10"""
)
def label_set_top_chains(s: Sample) -> DataFrame:
    return stats.label_set_chains(s.labels)


@query(
    "select code_language, count(*) as contract_count from label_rows "
    "where code_language is not null group by code_language"
)
def label_set_languages(s: Sample) -> DataFrame:
    return stats.label_set_languages(s.labels)


@query(
    "select count(*) as n_rows, "
    + ", ".join(
        f"count(*) filter (where {c} is null) as null_{c}, case when count(*) > 0 then "
        f"(1 - cast(count(*) filter (where {c} is null) as double) / count(*)) * 100 "
        f"end as {c}_pct"
        for c in ("address", "chain_id", "code_language")
    )
    + " from label_rows"
)
def null_counts(s: Sample) -> DataFrame:
    return quality.null_counts(s.labels)


@query(
    """
    select n_rows, n_valid, cast(n_valid as double) / n_rows * 100 as valid_pct,
           n_valid < n_rows * 0.95::double as low_share
    from (select count(*) as n_rows,
                 count(*) filter (where regexp_matches(address, '^0x[0-9a-fA-F]{40}$')) as n_valid
          from label_rows)"""
)
def address_pattern(s: Sample) -> DataFrame:
    return quality.address_pattern(s.labels)


@query(
    """
    select batch_id, count(*) as n_rows, count(*) - count(distinct address) as n_duplicates,
           count(*) > count(distinct address) as has_duplicates
    from batched group by batch_id"""
)
def duplicate_addresses(s: Sample) -> DataFrame:
    return quality.duplicate_addresses(s.batches(s.labels, "address"))


# -- batches ------------------------------------------------------------------------


@query(
    """
    select batch_id, min(verified_contract_id) as first_id, max(verified_contract_id) as last_id,
           count(*) as n_rows
    from batched group by batch_id"""
)
def batch_bounds(s: Sample) -> DataFrame:
    return batching.batch_bounds(s.batches(s.labels))


_RATE = "cast(n_successful as double) / n_rows * 100 as success_rate"


@query(f"select *, {_RATE} from outcome")
def batch_outcome(s: Sample) -> DataFrame:
    return batching.batch_outcome(s.delivery_batches(*DELIVERED))


@query(
    f"""
    select *, cast(total_successful as double) / total_rows * 100 as overall_rate,
           n_successful < n_rows * 0.5::double as low_success
    from (select *, {_RATE},
                 cast(sum(n_successful) over (order by batch_id) as bigint) as total_successful,
                 cast(sum(n_rows) over (order by batch_id) as bigint) as total_rows
          from outcome)"""
)
def batch_running_rate(s: Sample) -> DataFrame:
    return batching.running_rates(batching.batch_outcome(s.delivery_batches(*DELIVERED)))


@query(
    """
    select batch_id, count(*) filter (where valid) as n_labels,
           count(*) filter (where not valid) as n_skipped
    from delivery where not already_sent group by batch_id"""
)
def batch_payload_sizes(s: Sample) -> DataFrame:
    batches = s.delivery_batches(
        "already_sent", "valid", "address", "chain_ref", "tags"
    ).filter(~F.col("already_sent"))
    return batching.payload_sizes(batching.payloads(batches))


@query(
    """
    select batch_id, count(*) as n_sent, count(result_uid) as n_returned,
           count(result_uid) < count(*) as partial
    from delivery where valid and not already_sent group by batch_id"""
)
def batch_payload_results(s: Sample) -> DataFrame:
    return batching.payload_results(s.delivery_batches("already_sent", "valid", "result_uid"))


@query(
    """
    select batch_id, verified_contract_id, address, chain_id, 2 as attempt
    from delivery
    where not already_sent and not delivered and batch_id in (
      select batch_id from delivery where not already_sent group by batch_id
      having count(*) filter (where not delivered) < count(*) * 0.1::double)"""
)
def retry_candidates(s: Sample) -> DataFrame:
    return batching.retry_rows(s.delivery_batches(*DELIVERED, "address", "chain_id")).select(
        "batch_id", "verified_contract_id", "address", "chain_id", "attempt"
    )


@query(
    f"""
    select b.batch_num, (t.full_join + {BATCH_SIZE - 1}) // {BATCH_SIZE} as total_batches,
           cast({BATCH_SIZE} as bigint) as batch_size, b.batch_num * {BATCH_SIZE} as "offset",
           greatest(0, b.batch_num * {BATCH_SIZE} - {BATCH_SIZE}) as resume_offset,
           t.full_join - greatest(0, b.batch_num * {BATCH_SIZE} - {BATCH_SIZE}) as remaining
    from (select distinct batch_id + 1 as batch_num from batched) b, totals t"""
)
def resume_offset(s: Sample) -> DataFrame:
    total = s.engine.join_match_counts().select("full_join").scalar()
    batches = batching.batch_bounds(s.batches(s.labels))
    return batching.resume_points(batching.progress_rows(batches, BATCH_SIZE, total), total)


@query(
    """
    select run_id, cast(sum(n_skipped) as bigint) as total_skipped,
           cast(sum(n_processed) as bigint) as total_processed,
           cast(epoch(max(finished_at)) - epoch(min(started_at)) as double) / 3600
             as session_hours,
           cast(sum(n_skipped) as double) / sum(n_skipped + n_processed) * 100 as skip_rate
    from (select batch_id // 3 as run_id, count(*) filter (where already_sent) as n_skipped,
                 count(*) filter (where not already_sent) as n_processed,
                 min(verified_at) as started_at, max(verified_at) as finished_at
          from delivery group by batch_id)
    group by run_id"""
)
def session_stats(s: Sample) -> DataFrame:
    progress = s.delivery_batches("already_sent", "verified_at").groupBy("batch_id").agg(
        F.count_if("already_sent").alias("n_skipped"),
        F.count_if(~F.col("already_sent")).alias("n_processed"),
        F.min("verified_at").alias("started_at"),
        F.max("verified_at").alias("finished_at"),
    )
    runs = progress.withColumn("run_id", F.floor(F.col("batch_id") / 3).cast("long"))
    return batching.session_stats(runs)


@query(
    f"""
    select total_contracts, successful, total_contracts - successful as remaining,
           cast(ceil((total_contracts - successful) / {BATCH_SIZE}.0) as bigint)
             as estimated_batches,
           cast(ceil((total_contracts - successful) / {BATCH_SIZE}.0) as double)
             * {DELAY_SECONDS}::double / 3600::double as estimated_hours
    from (select full_join as total_contracts,
                 (select count(*) from ledger_state where status = 'success') as successful
          from totals)"""
)
def run_estimate(s: Sample) -> DataFrame:
    return s.engine.run_estimate(s.narrow_state, s.as_of, BATCH_SIZE, DELAY_SECONDS)


# -- ledger -------------------------------------------------------------------------

_STATE = "address, chain_id, seq, status, attempted_at, tx_hash, error_message, tags_json"


@query(f"select {_STATE} from ledger_state")
def ledger_state(s: Sample) -> DataFrame:
    return s.state


@query(
    """
    select count(*) as total_submissions,
           count(*) filter (where status = 'success') as successful,
           count(*) filter (where status = 'failed') as failed,
           count(*) filter (where status = 'pending') as pending,
           count(*) filter (where attempted_at > as_of - interval 1 hour) as recent_hour,
           case when count(*) > 0 then cast(count(*) filter (where status = 'success') as double)
             / count(*) * 100 else 0 end as success_rate
    from ledger_state, report_time"""
)
def ledger_stats(s: Sample) -> DataFrame:
    return ledger.ledger_stats(s.narrow_state, s.as_of)


@query(
    f"select {_STATE} from ledger_state, report_time "
    f"where attempted_at > as_of - interval 1 hour"
)
def recent_attempts(s: Sample) -> DataFrame:
    return ledger.recent_attempts(s.state, s.as_of)


@query(
    "select address, chain_id, attempted_at, error_message, tags_json from ledger_state "
    "where status = 'failed'"
)
def failed_report(s: Sample) -> DataFrame:
    return ledger.failed_report(s.state)


_SENT = "select address, chain_id from ledger_state where status = 'success'"


@query(f"select {LABEL_LIST} from label_rows where (lower(address), chain_id) not in ({_SENT})")
def unsent_labels(s: Sample) -> DataFrame:
    return s.engine.unsent_labels(s.sent)


@query(f"select {LABEL_LIST} from label_rows where (lower(address), chain_id) in ({_SENT})")
def already_sent_labels(s: Sample) -> DataFrame:
    return s.engine.already_sent_labels(s.sent)


@query(
    """
    select address, chain_id, min(verified_contract_id) as verified_contract_id
    from delivery where valid and not already_sent group by address, chain_id"""
)
def delivery_outbox(s: Sample) -> DataFrame:
    prepared = s.engine.prepared(s.engine.unsent_labels(s.sent))
    keys = prepared.filter("valid").select("address", "chain_id", "verified_contract_id")
    return label_ops.one_per_key(keys)


_STEPS = f"""
    , steps as (
      select verified_contract_id, address, chain_id, valid, 0 as step, 'pending' as status,
             timestamp '{START}' as attempted_at, cast(null as varchar) as error_message
      from delivery where not already_sent
      union all
      select verified_contract_id, address, chain_id, valid, 1 as step,
             case when valid then result_status else 'failed' end as status,
             timestamp '{START}' as attempted_at,
             case when valid then result_error else 'Validation failed' end as error_message
      from delivery where not already_sent and (not valid or result_status is not null))"""


@query(
    f"""{_STEPS}
    select verified_contract_id, lower(address) as address, chain_id, step, status, attempted_at,
           error_message from steps"""
)
def ledger_transitions(s: Sample) -> DataFrame:
    fresh = s.delivery.filter(~F.col("already_sent"))
    return ledger.attempt_rows(fresh, START).drop("shown_address", "tx_hash", "tags_json")


@query(
    f"""{_STEPS}
    select verified_contract_id, attempted_at, address, chain_id,
           replace(coalesce(error_message, ''), chr(10), ' ') as error_message
    from steps where status = 'failed'"""
)
def failure_log(s: Sample) -> DataFrame:
    attempts = ledger.attempt_rows(s.delivery.filter(~F.col("already_sent")), START)
    shown = attempts.withColumn("address", F.col("shown_address"))
    return ledger.failure_log_rows(shown, "verified_contract_id").drop("tags_json")


# -- file sets ------------------------------------------------------------------------


@query(
    """
    select 'export-' || cast(doc_id as varchar) as date_str, t.table_name,
           case t.table_name
             when 'verified_contracts'
               then 'verified_contracts/' || cast(doc_id as varchar) || '_' || t.part || '.parquet'
             when 'contract_deployments' then case when n_chars % 2 <> 0
               then 'contract_deployments/' || cast(doc_id as varchar) || '.parquet' end
           end as path
    from documents, (values ('verified_contracts', '0'), ('verified_contracts', '1'),
                     ('contract_deployments', ''), ('compiled_contracts', '')) t(table_name, part)"""
)
def manifest_files(s: Sample) -> DataFrame:
    return files.manifest_files(s.manifests).drop("file_name")


@query(
    """
    select t.table_name, count(l.file_name) as n_files, count(l.file_name) = 0 as is_missing
    from (values ('verified_contracts'), ('contract_deployments'), ('compiled_contracts'))
         t(table_name)
    left join listing l using (table_name) group by t.table_name"""
)
def required_table_files(s: Sample) -> DataFrame:
    return files.required_file_counts(s.listing)


@query(
    """
    select w.table_name, w.file_name,
           case when l.file_name is null then 'missing' else 'empty' end as problem
    from wanted_files w left join listing l using (table_name, file_name)
    where l.file_name is null or l.length = 0"""
)
def file_problems(s: Sample) -> DataFrame:
    return files.reconcile(s.wanted_files, s.listing)


@query(
    """
    select w.table_name, w.file_name, w.expected_length, l.length,
           coalesce(w.expected_length > 0 and w.expected_length = l.length, false) as complete
    from wanted_files w left join listing l using (table_name, file_name)"""
)
def file_completeness(s: Sample) -> DataFrame:
    return files.with_completeness(s.wanted_files, s.listing)


@query(
    """
    select coalesce(table_name, 'total') as table_name, count(*) as file_count,
           cast(round_even(coalesce(sum(length), 0) / 1048576, 1) as double) as size_mb
    from listing group by rollup (table_name)"""
)
def file_summary(s: Sample) -> DataFrame:
    return files.file_summary(s.listing)


@query("select doc_id, sha256(text) as sha256 from documents")
def file_digests(s: Sample) -> DataFrame:
    return s.source("documents").select(
        "doc_id", files.content_digest(F.col("text").cast("binary")).alias("sha256")
    )
