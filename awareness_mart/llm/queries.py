"""The corpus operators as queries over the given tables, and the SQL of those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoded, token_digest
from .chat import digest, expanded
from .codes import ENTRIES, POSITIONS, ROUNDS, vector_codes
from .common import read
from .decontaminate import contained_items
from .html_extract import extracted
from .language import predicted
from .near_dups import near_duplicates
from .negatives import hard_negatives
from .packing import packed
from .quality import judged
from .secret_scan import report
from .token_counts import token_counts
from .toxicity import scored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Words [^\x20\x09-\x0D]+ of a text t, A-Z lowered, as a DuckDB list.
_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


_SHINGLED = f"""
words as (select doc_id, {_WORDS} as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as s
  from words),
one as (select min(doc_id) as d, s from (select doc_id, list_sort(s) as s from sets where len(s) > 0) group by s),
rows_ as (select d, len(s) as n, unnest(s) as g from one),
rare as (select d, n, g from (select d, n, g, row_number() over (partition by d order by c, g) as r
  from rows_ join (select g, count(*) as c from rows_ group by g) using (g)) where r <= n - ceil(0.75 * n) + 1),
tried as (select distinct a.d as a, b.d as b from rare a join rare b on a.g = b.g and a.d < b.d
  and 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)),
near as (select a, b from tried join one x on x.d = a join one y on y.d = b
  where 175 * len(list_intersect(x.s, y.s)) >= 75 * (len(x.s) + len(y.s)))"""


@query(
    "op10_setsketch_near_dups",
    f"""with recursive {_SHINGLED},
both_ as (select a, b from near union all select b, a from near),
reach(d, c) as (select d, d from one union select both_.a, reach.c from reach join both_ on both_.b = reach.d),
component as (select d, min(c) as c from reach group by d),
label as (select s.doc_id, coalesce(component.c, s.doc_id) as component_id, len(s.s) as n_shingles
  from sets s left join one on one.s = list_sort(s.s) and len(s.s) > 0
  left join component on component.d = one.d)
select doc_id, cast(n_shingles as bigint) as n_shingles, component_id, doc_id = component_id as kept from label""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


@query("op6_markov_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read(spark, sf_dir, "documents"))


@query(
    "op8_benchmark_containment",
    f"""with words as (select doc_id, {_WORDS} as w from documents),
items as (select item_id, {_WORDS} as w from benchmark),
grams as (select doc_id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as g from words where len(w) > 0),
wanted as (select distinct item_id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as g from items where len(w) > 0),
size as (select item_id, count(*) as n_shingles from wanted group by item_id),
found as (select doc_id, item_id, count(*) as n_found from (select distinct * from grams) join wanted using (g) group by all)
select doc_id, item_id, n_shingles, n_found from found join size using (item_id) where 100 * n_found >= 75 * n_shingles""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    ).drop("row_hash")


@query(
    "op9_host_quality",
    r"""with texts as (select doc_id, source as host, coalesce(text, '') as t, row_number() over () as r from documents),
words as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from texts),
windows as (select r, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) as g
  from words where len(w) > 2),
twice as (select r, i from (select r, i, count(*) over (partition by r, g) as c from windows) where c > 1),
covered as (select r, count(distinct k) as n from (select r, unnest([i, i + 1, i + 2]) as k from twice) group by r),
counted as (select doc_id, host, len(w) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
  len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
  coalesce(n, 0) as n_repeat_words from words left join covered using (r)),
ruled as (select *, n_words < 50 as few_words, 100 * n_repeat_words > 50 * n_words as repeated,
  10 * n_symbols > n_words as symbols, 10 * n_dup_lines > 3 * n_lines as copied_lines,
  not (word_chars between 2 * n_words and 15 * n_words) as odd_words from counted),
failures as (select host, rule, avg(cast(failed as int)) as rate, sum(cast(failed as int)) as f, count(*) as n
  from ruled unpivot (failed for rule in (few_words, repeated, symbols, copied_lines, odd_words))
  where host is not null group by host, rule),
prior as (select rule, avg(rate) as m, case when var_pop(rate) > 0
  then greatest(1, avg(rate) * (1 - avg(rate)) / var_pop(rate) - 1) else 1 end as weight from failures group by rule),
bad as (select distinct host from failures join prior using (rule) where (f + m * weight) / (n + weight) >= 0.7)
select doc_id, ruled.host as host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
  few_words or repeated as base_failed, bad.host is not null as host_failed,
  not (few_words or repeated) and bad.host is null as kept
from ruled left join bad on ruled.host = bad.host""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged(read(spark, sf_dir, "documents")).select(
        "doc_id", *counts, "base_failed", "kept", "host", "n_lines", "host_failed"
    )


def _held_out(parts: int, part: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


@query("op4_toxic_segments")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return scored(docs, labels, _held_out(5, 0))


@query("op5_language_bloom")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(read(spark, sf_dir, "documents"), _held_out(4, 2))


_ESCAPED = r"""length({0}) + length({0}) - length(replace({0}, '\', ''))
  + length({0}) - length(regexp_replace({0}, '#+', '', 'g')) - len(regexp_extract_all({0}, '#+'))
  + len(regexp_extract_all({0}, '</turn>'))"""


@query(
    "op7_prefix_target_chat",
    f"""with rows_ as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, unnest([0, 1]), unnest(['user', 'assistant']), '\\### Assistant: </turn> ok'),
sized as (select *, 4 + 2 + 8 + {_ESCAPED.format('role')} + length(role) - length(replace(role, ':', ''))
    + {_ESCAPED.format('text')} as n from rows_),
summed as (select *, sum(n) over w as through, lead(turn) over w is null as last
  from sized window w as (partition by conv_id order by turn, role, text rows unbounded preceding))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(through) filter (role = 'assistant' or last)::bigint as formatted_chars
from summed group by conv_id""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(
        r"""select -7L as conv_id, turn, role, r'\### Assistant: </turn> ok' as text
        from values (0L, 'user'), (1L, 'assistant') as t(turn, role)"""
    )
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest(expanded(rows.union(extra)))


@query("op2_token_attribution")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))


@query("op3_wrapper_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read(spark, sf_dir, "pages"))


@query("op13_bpe_merge_rounds")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(encoded(read(spark, sf_dir, "documents")))


_WHOLE = """embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""


def _lloyd_sql() -> str:
    """The rounds written out; distances and entry in one number, so that the least is the nearest."""
    near = f"""select r, p, min(a) % {ENTRIES} as e, min(a) // {ENTRIES} as d from (
    select parts.r, parts.p, {ENTRIES} * cast(list_inner_product(x, x) - 2 * list_inner_product(x, c)
      + list_inner_product(c, c) as bigint) + books.e as a
    from parts join {{books}} as books on books.p = parts.p) group by r, p"""
    steps = [
        f"""kept as materialized (select row_number() over (order by vec_id) - 1 as r, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings where {_WHOLE}),
  parts as materialized (select r, p, v[p * (len(v) // {POSITIONS}) + 1 : (p + 1) * (len(v) // {POSITIONS})] as x
    from kept, range({POSITIONS}) as t(p)),
  books0 as materialized (select p, r as e, x as c from parts where r < {ENTRIES})"""
    ]
    for k in range(ROUNDS):
        steps.append(f"""near{k} as materialized ({near.format(books=f"books{k}")}),
  mean{k} as (select p, e, list(m order by i) as c from (
    select p, e, i, floor(sum(x) / count(*)) as m from (
      select near{k}.p, near{k}.e, unnest(x) as x, generate_subscripts(x, 1) as i
      from near{k} join parts using (r, p)) group by p, e, i) group by p, e),
  books{k + 1} as materialized (select p, e, coalesce(mean{k}.c, books{k}.c) as c
    from books{k} left join mean{k} using (p, e))""")
    return f"""with {", ".join(steps)},
  last_ as ({near.format(books=f"books{ROUNDS}")}),
  codes as (select r, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error
    from last_ group by r),
  said as (select sha256(string_agg(cast(cast(x as bigint) as varchar), ',' order by p, e, i)) as s from (
    select p, e, unnest(c) as x, generate_subscripts(c, 1) as i from books{ROUNDS}))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  s as codebooks_sha256 from kept join codes using (r), said"""


@query("op11_resident_lloyd", _lloyd_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(read(spark, sf_dir, "embeddings"))


@query(
    "op12_windowed_negatives",
    f"""with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings where label is not null and {_WHOLE}),
scores as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
  cast(list_inner_product(a.v, b.v) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positive as (select anchor_id, id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, cast(row_number() over w as int) as rank, id as negative_id,
  positive_score, score as negative_score
from positive join scores using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
window w as (partition by anchor_id, positive_id order by score desc, id) qualify row_number() over w <= 5""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
