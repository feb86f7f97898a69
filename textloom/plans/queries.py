"""Queries over the driver's tables and over inline cases, each with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..boundary import LocalSandbox, canned
from ..functions.json_text import extract_json
from ..functions.text import compare_complexity, normalize_complexity, parse_queries
from ..functions.urls import SQL_DOMAIN, SQL_PROTOCOL, domain, has_url, protocol
from ..operators import collect, convert, enrich, qa, sample, scoring, stats, validate
from ..sources import files, sinks
from . import cases

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _values(rows, names: str) -> str:
    """An inline table for DuckDB."""

    def cell(x):
        if x is None:
            return "null"
        if isinstance(x, bool):
            return str(x).lower()
        if isinstance(x, int):
            return f"{x}::bigint"
        if isinstance(x, float):
            return f"{x!r}::double"
        return "'" + x.replace("'", "''") + "'"

    return "(values " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") v({names})"


# -- URL statistics
_PARTS = f"(select {SQL_PROTOCOL.format('url')} as protocol, {SQL_DOMAIN.format('url')} as domain from pages where url is not null and url <> '')"
_DOMAINS = f"(select domain, count(*)::bigint as n from {_PARTS} where domain <> '' group by domain)"


@query(f"""
select (select count(*) from pages)::bigint as total_records, coalesce(sum(n), 0)::bigint as valid_urls,
  ((select count(*) from pages) - coalesce(sum(n), 0))::bigint as invalid_urls, count(*)::bigint as unique_domains_total,
  count(*) filter (where n >= 2)::bigint as unique_domains_filtered, 2::bigint as min_frequency_threshold from {_DOMAINS}""")
def url_summary(spark, sf_dir):
    return stats.url_summary(_read(spark, sf_dir, "pages"), 2)


@query(f"select url, case when {SQL_DOMAIN.format('url')} is null then null else {SQL_PROTOCOL.format('url')} end as protocol, {SQL_DOMAIN.format('url')} as domain from {_values([(u,) for u in cases.PLAIN_URLS], 'url')}")
def url_edge_cases(spark, sf_dir):
    df = spark.createDataFrame([(u,) for u in cases.PLAIN_URLS], "url string")
    return df.select("url", protocol(F.col("url")).alias("protocol"), domain(F.col("url")).alias("domain"))


@query("select * from " + _values(cases.URLS, "url, protocol, domain, valid"))
def url_golden_cases(spark, sf_dir):
    df = spark.createDataFrame([(u,) for u, *_ in cases.URLS], "url string")
    d = domain(F.col("url"))
    return df.select("url", protocol(F.col("url")).alias("protocol"), d.alias("domain"), (has_url(F.col("url")) & (F.coalesce(d, F.lit("")) != "")).alias("valid")).withColumn("valid", F.coalesce("valid", F.lit(False)))


@query(f"select protocol, count(*)::bigint as n, round(count(*) * 100.0::double / sum(count(*)) over (), 2) as pct from {_PARTS} where domain <> '' group by protocol")
def protocol_distribution(spark, sf_dir):
    return stats.protocol_counts(_read(spark, sf_dir, "pages"))


@query(f"select domain, n from {_DOMAINS} where n >= 2 order by n desc, domain limit 100")
def domain_distribution(spark, sf_dir):
    return stats.domain_counts(_read(spark, sf_dir, "pages"), 2).orderBy(F.desc("n"), "domain").limit(stats.TOP)


@query(f"select domain, n from {_DOMAINS} where n >= 2")
def filtered_domains(spark, sf_dir):
    return stats.domain_counts(_read(spark, sf_dir, "pages"), 2, prune_many=True)


@query(f"select domain, n, round(n * 100.0::double / (select sum(n) from {_DOMAINS}), 2) as pct from {_DOMAINS} order by n desc, domain limit 20")
def top_domain_shares(spark, sf_dir):
    return stats.top_shares(_read(spark, sf_dir, "pages"), 20)


# -- collection
_TARGETS = f"(select domain, n from (select domain, n from {_DOMAINS} order by n desc, domain limit 100) where n >= 5)"
_COLLECTED = f"(select page_id, url, {SQL_DOMAIN.format('url')} as domain, 'f' || (page_id % 4)::varchar as file_source from pages where url is not null and url <> '' and {SQL_DOMAIN.format('url')} in (select domain from {_TARGETS}))"
MIN = 5


def _pages(spark, sf_dir) -> DataFrame:
    """Pages without their bodies, with a stand-in for the file that each came from."""
    return _read(spark, sf_dir, "pages").select("page_id", "url", F.concat(F.lit("f"), F.pmod("page_id", F.lit(4))).alias("part"))


def _collected(spark, sf_dir) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return collect.collect(pages, collect.target_domains(pages, MIN), file_column="part")


@query(f"select domain, n from {_TARGETS}")
def target_domains(spark, sf_dir):
    return collect.target_domains(_read(spark, sf_dir, "pages"), MIN)


@query(f"select page_id, url, domain, replace(domain, '.', '_') as domain_dir, file_source from {_COLLECTED}")
def collect_by_domain(spark, sf_dir):
    return collect.with_folder(_collected(spark, sf_dir)).drop("part")


@query(f"select domain, count(*)::bigint as n from {_COLLECTED} group by domain")
def collection_domain_stats(spark, sf_dir):
    return collect.domain_totals(_collected(spark, sf_dir))


@query(f"""
select p.file, p.processed, coalesce(c.collected, 0)::bigint as collected, coalesce(c.saved, 0)::bigint as saved
from (select 'f' || (page_id % 4)::varchar as file, count(*)::bigint as processed from pages group by 1) p
left join (select file_source as file, count(*) as collected, count(distinct domain) as saved from {_COLLECTED} group by 1) c using (file)""")
def collection_file_stats(spark, sf_dir):
    return collect.file_totals(_pages(spark, sf_dir), _collected(spark, sf_dir), "part")


@query(f"""
select case grouping(file_source) * 2 + grouping(domain) when 0 then 'file_domain' when 1 then 'file' when 2 then 'domain' else 'total' end as level,
  file_source as file, domain, count(*)::bigint as n, count(distinct domain)::bigint as n_domains from {_COLLECTED} group by cube (file_source, domain)""")
def collection_levels(spark, sf_dir):
    return collect.by_file_and_domain(_collected(spark, sf_dir))


@query(f"select (select count(*) from pages)::bigint as processed, (select count(*) from {_COLLECTED})::bigint as collected, round((select count(*) from {_COLLECTED}) * 100.0::double / (select count(*) from pages), 2) as rate")
def collection_rate(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages")
    return collect.collection_rate(pages, collect.target_domains(pages, MIN))


@query(f"select domain, count(*)::bigint as total_urls, count(distinct file_source)::bigint as source_files from {_COLLECTED} group by domain")
def consolidation_stats(spark, sf_dir):
    return collect.consolidated(_collected(spark, sf_dir))


# -- samples
@query(f"select page_id, domain from (select page_id, domain, row_number() over (partition by domain order by md5('42:' || page_id::varchar), page_id) as rn from {_COLLECTED}) where rn <= 3")
def domain_sample(spark, sf_dir):
    return sample.sample_rows(_collected(spark, sf_dir), "page_id", 3).select("page_id", "domain")


_CHOSEN = f"(select domain, file_source, file_rows from (select *, row_number() over (partition by domain order by md5('42:' || domain || ':' || file_source), file_source) as r from (select domain, file_source, count(*)::bigint as file_rows from {_COLLECTED} group by all)) where r <= 2)"


@query(f"select page_id, domain, file_source from (select c.*, row_number() over (partition by domain order by md5('42:' || page_id::varchar), page_id) as rn from {_COLLECTED} c semi join {_CHOSEN} x using (domain, file_source)) where rn <= 3")
def cluster_sample(spark, sf_dir):
    return sample.cluster_sample(_collected(spark, sf_dir), "page_id", "file_source", 3, 2).select("page_id", "domain", "file_source")


_REPORT = f"(select domain, total_files, selected_files, valid_data, least(valid_data, 3)::bigint as sampled from (select domain, count(distinct file_source)::bigint as total_files from {_COLLECTED} group by domain) join (select domain, count(*)::bigint as selected_files, sum(file_rows)::bigint as valid_data from {_CHOSEN} group by domain) using (domain))"


def _report(spark, sf_dir, every: bool = False) -> DataFrame:
    domains = stats.domain_counts(_read(spark, sf_dir, "pages")) if every else None
    return sample.sampling_report(_collected(spark, sf_dir), "file_source", 3, 2, domains=domains)


@query(f"select * from {_REPORT}")
def sampling_summary(spark, sf_dir):
    return _report(spark, sf_dir)


@query(f"select count(*)::bigint as total_domains, count(sampled)::bigint as successful_samples, (count(*) - count(sampled))::bigint as failed_samples, coalesce(sum(sampled), 0)::bigint as total_sampled from {_DOMAINS} left join {_REPORT} using (domain)")
def sampling_totals(spark, sf_dir):
    return sample.sampling_totals(_report(spark, sf_dir, True))


# -- increments
@query("select d.doc_id from documents d anti join labels l using (doc_id)")
def pending_items(spark, sf_dir):
    return convert.pending(_read(spark, sf_dir, "documents").select("doc_id"), _read(spark, sf_dir, "labels"), "doc_id")


def _existing(spark, sf_dir) -> DataFrame:
    """Labels as results of an earlier run; those of low quality have failed."""
    return _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("question_id"), F.lit("old").alias("task_id"), F.lit("r").alias("response"), F.when(F.col("quality") == 1, F.concat(F.lit('{"toxic": '), F.col("toxic"), F.lit("}"))).alias("complexity_data"))


def _problems(spark, sf_dir) -> DataFrame:
    return _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("question_id"), F.col("source").alias("task_id"), F.col("text").alias("problem_description"), F.col("text").alias("python"), F.col("lang").alias("difficulty"))


_STATE = """(select doc_id::varchar as question_id, case when l.doc_id is null then coalesce(d.source, '') else 'old' end as task_id, case when l.quality = 1 then '{"toxic": ' || l.toxic::varchar || '}' end as complexity_data, coalesce(l.quality, 0) <> 1 as needs_call from documents d left join labels l using (doc_id))"""


@query(f"select question_id, task_id, complexity_data, needs_call from {_STATE}")
def resume_upsert(spark, sf_dir):
    return enrich.resume(_problems(spark, sf_dir), _existing(spark, sf_dir)).drop("response")


#: Replies only to texts with a capital E in them; everything else fails each round.
_MODEL = canned({"E": 'so: ```json\n{"time_complexity": "O(n)"}\n```'}, default="no idea")


@query(f"""select question_id, task_id, case when not needs_call then complexity_data when contains(d.text, 'E') then '{{"time_complexity": "O(n)"}}' end as complexity_data from {_STATE} s join documents d on s.question_id = d.doc_id::varchar""")
def enrich_rounds(spark, sf_dir):
    out = enrich.enrich(_problems(spark, sf_dir), _MODEL, _existing(spark, sf_dir), prompt="{problem_description}|{code}")
    return out.drop("response")


@query(f"select count(*)::bigint as total, count(complexity_data)::bigint as total_with_complexity from {_STATE}")
def enrichment_totals(spark, sf_dir):
    return enrich.with_results(enrich.resume(_problems(spark, sf_dir), _existing(spark, sf_dir)))


# -- questions and answers
def _complexity(spark, sf_dir) -> DataFrame:
    """Labels as stand-in for what is known of each problem's complexity."""
    known = F.struct(F.concat(F.lit("O(n^"), F.col("quality"), F.lit(")")).alias("time_complexity"), F.concat(F.lit("O("), F.col("toxic"), F.lit(")")).alias("space_complexity"), F.lit("since {braces} stay").alias("explanation"))
    return _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("question_id"), F.when(F.col("toxic").isNotNull(), known).alias("complexity_data"))


_QA = "(select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, text, 'O(n^' || quality::varchar || ')' as t, 'O(' || toxic::varchar || ')' as s from documents join labels using (doc_id) where toxic is not null and coalesce(text, '') <> '')"
_FIXED = f"'{qa.TASK}' as task_id, '{qa.STYLE}' as style, '{qa.SOURCE}' as data_source, '' as repo_name"
_FLAT = ("task_id", "question", "reward.ground_truth", "reward.style", "data_source", "repo_name", "extra_info.id", "extra_info.question_id", "extra_info.leetcode_task_id", "extra_info.difficulty", "extra_info.type")


def _sql_text(template: str, **cols: str) -> str:
    import string

    parts = [("'" + text.replace("'", "''") + "'", cols[name] if name else None) for text, name, _, _ in string.Formatter().parse(template)]
    return " || ".join(x for pair in parts for x in pair if x and x != "''")


_Q = {"task_id": "source", "problem_description": "text", "code": "text", "time_complexity": "t", "space_complexity": "s", "explanation": "'since {braces} stay'"}


@query(f"select {_FIXED}, {_sql_text(qa.QUESTION, **_Q)} as question, {_sql_text(qa.ANSWER, **_Q)} as ground_truth, 'complexity_' || doc_id::varchar || '_basic' as id, doc_id as question_id, source as leetcode_task_id, lang as difficulty, '{qa.TYPE}' as type, 'basic' as pair_id, t as time_complexity, s as space_complexity, false as llm_generated from {_QA}")
def qa_pairs_basic(spark, sf_dir):
    return qa.basic_records(_problems(spark, sf_dir), _complexity(spark, sf_dir)).select(*_FLAT, "extra_info.pair_id", "extra_info.time_complexity", "extra_info.space_complexity", "extra_info.llm_generated")


@query(f"select doc_id as question_id, 'complexity_' || doc_id::varchar || '_basic' as id from {_QA} order by doc_id limit 7")
def qa_pairs_limited(spark, sf_dir):
    return qa.basic_records(_problems(spark, sf_dir), _complexity(spark, sf_dir), limit=7).select("extra_info.question_id", "extra_info.id")


@query(f"""select {_FIXED}, x.q as question, x.g as ground_truth, 'complexity_' || doc_id::varchar || '_' || x.i as id, doc_id as question_id, source as leetcode_task_id, lang as difficulty, '{qa.TYPE}' as type, x.i as query_id, x.c as complexity_type, t as original_time_complexity, s as original_space_complexity, true as llm_generated
from {_QA} cross join (values ('1', 'TIME', 'How long?', 'O(n)'), ('unknown', 'SPACE', 'How much' || chr(10) || 'room?', 'O(1)')) x(i, c, q, g)""")
def qa_pairs_model(spark, sf_dir):
    out = qa.model_records(_problems(spark, sf_dir), _complexity(spark, sf_dir), canned({}, default=cases.REPLY))
    return out.select(*_FLAT, "extra_info.query_id", "extra_info.complexity_type", "extra_info.original_time_complexity", "extra_info.original_space_complexity", "extra_info.llm_generated")


_KINDS = "select 'difficulty' as kind, lang as key, {0} as w from {1} union all select 'time_complexity', {2}, 1 from {1} union all select 'space_complexity', {3}, 1 from {1}"


@query(f"select kind, key, sum(w)::bigint as n from ({_KINDS.format(1, _QA, 't', 's')}) group by kind, key")
def difficulty_distribution(spark, sf_dir):
    return qa.distributions(qa.basic_records(_problems(spark, sf_dir), _complexity(spark, sf_dir)))


@query(f"""select kind, key, sum(w)::bigint as n from ({_KINDS.format(2, _QA, "'O(n)'", "'O(1)'")} union all select 'complexity_type', c, 1 from {_QA} cross join (values ('TIME'), ('SPACE')) x(c)) group by kind, key""")
def model_distribution(spark, sf_dir):
    return qa.distributions(qa.model_records(_problems(spark, sf_dir), _complexity(spark, sf_dir), canned({}, default=cases.REPLY)))


@query(f"""
with s as (select n, regexp_extract(reply, '(?s)===QUERIES_START===(.*?)===QUERIES_END===', 1) as s from {_values(list(enumerate(cases.REPLIES)), 'n, reply')}),
b as (select n, regexp_extract_all(s, '(?s)===QUERY_START===(.*?)===QUERY_END===', 1) as bs from s),
u as (select n, unnest(bs) as b, generate_subscripts(bs, 1) as i from b),
f as (select n, i, coalesce(nullif(regexp_extract(b, 'QUERY_ID:\\s*(\\d+)', 1), ''), 'unknown') as query_id, regexp_extract(b, 'COMPLEXITY_TYPE:\\s*([A-Z]+)', 1) as complexity_type,
  trim(regexp_extract(b, '(?s)QUERY:\\s*(.*?)\\s*GROUND_TRUTH:', 1)) as query, trim(regexp_extract(b, 'GROUND_TRUTH:\\s*([^\\n]+)', 1)) as ground_truth from u)
select n, (row_number() over (partition by n order by i) - 1)::bigint as pos, query_id, complexity_type, query, ground_truth from f
where query <> '' and complexity_type <> '' and ground_truth <> ''""")
def parse_model_replies(spark, sf_dir):
    df = spark.createDataFrame(list(enumerate(cases.REPLIES)), "n long, reply string")
    q = df.select("n", F.posexplode(parse_queries(F.col("reply"))).alias("pos", "q"))
    return q.select("n", F.col("pos").cast("long").alias("pos"), "q.query_id", "q.complexity_type", "q.query", "q.ground_truth")


# -- scores
_WS = "[\\s\\x1c-\\x1f]*"
_NORM = f"lower(regexp_replace(raw, '^{_WS}|{_WS}$', '', 'g'))"
for _p, _r in (("θ\\(([^)]+)\\)", "O(\\1)"), ("ω\\(([^)]+)\\)", "O(\\1)"), ("o\\(([^)]+)\\)", "O(\\1)")):
    _NORM = f"regexp_replace({_NORM}, '{_p}', '{_r}', 'g')"
_NORM = f"(case when starts_with({_NORM}, 'o(') and not ends_with({_NORM}, ')') then {_NORM} || ')' else {_NORM} end)"
_STEPS = [("\\s*\\*\\s*", "*"), ("\\s*\\+\\s*", "+"), ("\\s*\\^\\s*", "^"), ("log\\s*\\(\\s*n\\s*\\)", "log n"), ("logn\\b", "log n"), ("n\\s*\\*\\s*log\\s+n", "n log n"), ("²", "^2"), ("³", "^3"), ("\\*\\*", "^")]
_STEP = "x"
for _p, _r in _STEPS:
    _STEP = f"regexp_replace({_STEP}, '{_p}', '{_r}', 'g')"
_NORMALISED = f"""(with a as (select raw, {_NORM} as x from {_values([(r,) for r in cases.NOTATIONS], "raw")}), b as (select raw, {_STEP} as x from a), c as (select raw, x, regexp_replace(x, '^([^o].*)', 'O(\\1)') as w from b)
select raw, case when raw is null or raw = '' then '' when starts_with(x, 'o(') then x when ends_with(w, ')') then w else w || ')' end as normalized from c)"""


@query(f"select * from {_NORMALISED}")
def normalize_complexities(spark, sf_dir):
    df = spark.createDataFrame([(r,) for r in cases.NOTATIONS], "raw string")
    return df.select("raw", normalize_complexity(F.col("raw")).alias("normalized"))


@query("select * from " + _values(cases.PAIRS, "a, b, equal"))
def compare_complexities(spark, sf_dir):
    df = spark.createDataFrame([p[:2] for p in cases.PAIRS], "a string, b string")
    return df.select("a", "b", compare_complexity(F.col("a"), F.col("b")).alias("equal"))


@query("select * from " + _values([(i, *r) for i, r in enumerate(cases.SCORED)], "case_id, score, method_used, extracted_complexity"))
def score_complexities(spark, sf_dir):
    df = spark.createDataFrame([(i, s, t) for i, (s, t, _) in enumerate(cases.COMPLEXITY)], "case_id long, solution_str string, ground_truth string")
    return scoring.score_complexity(df, cases.judge).select("case_id", "score", "method_used", "extracted_complexity")


@query("select 26::bigint as n, 26::bigint as passed, 1.0::double as rate")
def complexity_pass_rate(spark, sf_dir):
    df = spark.createDataFrame([(s, t, e) for s, t, e in cases.COMPLEXITY], "solution_str string, ground_truth string, expected_score double")
    return scoring.pass_rate(scoring.score_complexity(df, cases.judge))


@query("select * from " + _values([(i, j) for i, (_, j) in enumerate(cases.JSON_REPLIES)], "case_id, found"))
def extract_json_values(spark, sf_dir):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases.JSON_REPLIES)], "case_id long, raw string")
    return df.select("case_id", extract_json(F.col("raw")).alias("found"))


@query("select * from " + _values([(i, s, v) for i, (_, _, _, s, v) in enumerate(cases.CODE)], "case_id, score, valid_code").replace("valid_code)", "valid_code)"))
def score_code(spark, sf_dir):
    df = spark.createDataFrame([(i, s, p, t) for i, (s, p, t, _, _) in enumerate(cases.CODE)], "case_id long, solution_str string, import_code string, test_code string")
    out = scoring.score_code(df.repartition(4, "case_id"), LocalSandbox(timeout=10.0))
    return out.select("case_id", "score", F.col("valid_code").cast("long").alias("valid_code"))


# -- validation
def _lines(spark) -> DataFrame:
    return spark.createDataFrame([(i + 1, t) for i, (t, _, _) in enumerate(cases.RECORDS)], "line_num long, value string")


_CHECKED = [(i + 1, e, w) for i, (_, e, w) in enumerate(cases.RECORDS) if e is not None]


@query("select * from " + _values(_CHECKED, "line_num, n_errors, n_warnings"))
def validate_records(spark, sf_dir):
    return validate.validate(_lines(spark)).select("line_num", F.size("errors").cast("long").alias("n_errors"), F.size("warnings").cast("long").alias("n_warnings"))


@query(f"select count(*)::bigint as total_lines, count(*) filter (where n_errors = 0)::bigint as valid_lines, sum(n_errors)::bigint as total_errors, sum(n_warnings)::bigint as total_warnings, round(count(*) filter (where n_errors = 0) * 100.0::double / count(*), 1) as success_rate, sum(n_errors) = 0 as passed from {_values(_CHECKED, 'line_num, n_errors, n_warnings')}")
def validation_summary(spark, sf_dir):
    return validate.summary(validate.validate(_lines(spark)))


@query("select count(*)::bigint as total_lines, 0::bigint as valid_lines, (6 * count(*))::bigint as total_errors, count(*)::bigint as total_warnings, 0.0::double as success_rate, false as passed from events where trim(coalesce(props, '')) <> ''")
def validate_event_props(spark, sf_dir):
    """Every event's small JSON object as a record: none of the six fields is there, and one that is not known."""
    lines = _read(spark, sf_dir, "events").select(F.col("props").alias("value"))
    return validate.summary(validate.validate(lines))


# -- conversion
def _content(spark, sf_dir) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", F.coalesce(domain(F.col("url")), F.lit("")).alias("folder"), F.concat(F.lit("f"), F.pmod("page_id", F.lit(4))).alias("source_file"), F.col("html").alias("content"))


@query(f"select coalesce({SQL_DOMAIN.format('url')}, '') as folder, count(distinct page_id % 4)::bigint as source_files, count(*)::bigint as total_items, count(*) filter (where coalesce(html, '') <> '')::bigint as processed_items, 0::bigint as error_items, true as success from pages group by 1")
def markdown_status(spark, sf_dir):
    return convert.status(convert.convert(_content(spark, sf_dir)))


@query(f"select count(distinct coalesce({SQL_DOMAIN.format('url')}, ''))::bigint as successful, 0::bigint as failed, count(*)::bigint as total_items, count(*) filter (where coalesce(html, '') <> '')::bigint as processed_items, 0::bigint as error_items, round(count(*) filter (where coalesce(html, '') <> '') * 100.0::double / count(*), 1) as rate from pages")
def markdown_totals(spark, sf_dir):
    return convert.totals(convert.status(convert.convert(_content(spark, sf_dir))))


@query()
def html_to_markdown(spark, sf_dir):
    return convert.convert(_content(spark, sf_dir)).select("page_id", "content", "content_format")


@query("select * from " + _values([(i, m) for i, (_, m) in enumerate(cases.MARKDOWN)], "case_id, content"))
def markdown_cases(spark, sf_dir):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(cases.MARKDOWN)], "case_id long, content string")
    return convert.convert(df).select("case_id", "content")


# -- readers and writers: each writes its table below the shared folder and reads it back
_LABELS = "doc_id bigint, quality bigint, toxic bigint"


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "labels").selectExpr(*(f"cast({c.split(' ')[0]} as bigint) as {c.split(' ')[0]}" for c in _LABELS.split(", ")))


@query("select doc_id::bigint as doc_id, quality::bigint as quality, toxic::bigint as toxic from labels")
def json_array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = enrich._folder(spark, "arrays")
    sinks.write_records(_labels(spark, sf_dir), path)
    return files.read_json_arrays(spark, path, _LABELS).drop("source_file")


@query("select doc_id::varchar as question_id, quality::bigint as quality, toxic::bigint as toxic from labels where doc_id is not null")
def keyed_json_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key stands twice; the row that is last in ``_order`` counts."""
    path = f"{enrich._folder(spark, 'keyed')}.json"
    rows = _labels(spark, sf_dir).withColumnRenamed("doc_id", "question_id")
    first = rows.selectExpr("question_id", "-1L as quality", "-1L as toxic", "0 as _order")
    sinks.write_keyed(first.unionByName(rows.withColumn("_order", F.lit(1))), path)
    return files.read_keyed_json(spark, path, "quality bigint, toxic bigint")


@query("select doc_id::varchar as question_id, source as task_id, n_chars::bigint as n_chars from documents where doc_id is not null")
def problem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key stands on two lines of a file; the later line counts."""
    path = enrich._folder(spark, "lines")
    docs = _read(spark, sf_dir, "documents").where("doc_id is not null")
    rows = docs.selectExpr("doc_id as question_id", "source as task_id", "cast(n_chars as bigint) as n_chars", "1 as later")
    both = rows.unionByName(rows.selectExpr("question_id", "'old' as task_id", "-1L as n_chars", "0 as later"))
    both.repartition("question_id").sortWithinPartitions("later").drop("later").write.json(path)
    return files.read_problems(spark, path, "question_id bigint, task_id string, n_chars bigint")


@query("""
select count(*)::bigint as total_lines, count(*) filter (where quality = 1)::bigint as valid_lines, (2 * count(*) filter (where quality <> 1))::bigint as total_errors,
  count(*) filter (where toxic = 1)::bigint as total_warnings, coalesce(round(count(*) filter (where quality = 1) * 100.0::double / nullif(count(*), 0), 1), 0.0::double) as success_rate,
  (count(*) filter (where quality <> 1)) = 0 as passed from labels where quality is not null and toxic is not null""")
def validate_file_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per label: one of low quality has a blank question and an unknown style, a toxic one a field too many."""
    path = enrich._folder(spark, "records")
    good = F.col("quality") == 1
    reward = F.struct(F.lit("O(n)").alias("ground_truth"), F.when(good, "rule").otherwise("other").alias("style"))
    record = F.struct(F.lit("t").alias("task_id"), F.when(good, "q").otherwise(" ").alias("question"), reward.alias("reward"), F.lit("s").alias("data_source"), F.lit("r").alias("repo_name"), F.struct(F.lit(1).alias("id")).alias("extra_info"), F.when(F.col("toxic") == 1, "more").alias("note"))
    _labels(spark, sf_dir).where("quality is not null and toxic is not null").select(F.to_json(record).alias("value")).write.text(path)
    totals = validate.validate_file(spark, path)[1]
    kinds = "total_lines bigint, valid_lines bigint, total_errors bigint, total_warnings bigint, success_rate double, passed boolean"
    return spark.createDataFrame([totals], kinds)
