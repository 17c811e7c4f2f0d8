"""The registered queries of this subpackage: each applies one operator, with production
parameters, to its whole table.  ``ORACLE`` holds DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drapekit.llm.align import alignment
from drapekit.llm.bpe import round_trip
from drapekit.llm.chat_format import format_chats
from drapekit.llm.collocations import collocations
from drapekit.llm.common import table
from drapekit.llm.decontaminate import leaks
from drapekit.llm.licenses import license_scan
from drapekit.llm.lm_scoring import lm_scores
from drapekit.llm.order_minhash import edited_likeness
from drapekit.llm.quality import ablations, apply_policy, ledger
from drapekit.llm.simhash import simhash_groups
from drapekit.llm.suffix_dedup import suffix_dedup
from drapekit.llm.token_counts import Rollup
from drapekit.llm.toxicity import toxicity
from drapekit.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# DuckDB: words are runs of other characters than 0x20 and 0x09-0x0D
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@_query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), length=200)


# every 200-byte string as hex text, cut from pieces of 264 bytes
ORACLE["op1_suffix_dedup"] = """
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
cut as (select r, unnest(range(0, len(h) // 2, 64)) as c from d),
part as (select r, c, substr(h, 2 * c + 1, 2 * 264) as p from cut join d using (r)),
starts as (select r, c + k as i, md5(substr(p, 2 * k + 1, 400)) as name from (select *, unnest(range(0, least(64, len(p) // 2 - 199))) as k from part)),
again as (select r, i from (select r, i, count(*) over (partition by name) as n from starts) where n > 1),
span as (
  select r, min(i) as a, max(i) + 200 as b from (
    select r, i, sum(new) over (partition by r order by i) as g from (
      select r, i, case when i - lag(i) over (partition by r order by i) <= 200 then 0 else 1 end as new from again))
  group by r, g),
gone as (
  select r, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last, string_agg(piece, '' order by a) as before from (
    select s.r, a, b, substr(h, 2 * before + 1, 2 * (a - before)) as piece from (
      select *, lag(b, 1, 0) over (partition by r order by a) as before from span) s join d on s.r = d.r)
  group by r)
select doc_id, len(h) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join gone using (r)"""


@_query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_policy(ledger(table(spark, sf_dir, "documents")))


ORACLE["op10_quality_rules"] = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text, {_WORDS} as w from documents),
words as (select r, unnest(w) as word, generate_subscripts(w, 1) as i from d),
win as (select r, i, word, lead(word) over (partition by r order by i) as b, lead(word, 2) over (partition by r order by i) as c from words),
rep as (select r, i from (select r, i, count(*) over (partition by r, word, b, c) as n from win where c is not null) where n > 1),
cover as (select r, count(distinct i + k) as n from rep, (select unnest([0, 1, 2]) as k) group by r),
lines as (select r, unnest(string_split(text, chr(10))) as line from d),
dup as (select r, count(*) as n_lines, count(*) - count(distinct line) as n from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (
  select d.doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(dup.n, 0) as n_dup_lines, coalesce(cover.n, 0) as n_repeat_words,
    coalesce(dup.n_lines, 0) as n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as n_alpha_words
  from d left join dup using (r) left join cover using (r)),
f as (
  select *, ((case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
    + (case when 100 * n_symbols > 10 * word_chars then 4 else 0 end) + (case when 100 * n_alpha_words < 70 * n_words then 8 else 0 end)
    + (case when 100 * n_dup_lines > 40 * n_lines then 16 else 0 end)
    + (case when word_chars < 2 * n_words or word_chars > 15 * n_words then 32 else 0 end))::bigint as fail_bits
  from m)
select *, (fail_bits & 3) <> 0 as base_failed, fail_bits = 0 as kept from f"""


@_query
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10's ablations over the ledger of all documents."""
    return ablations(ledger(table(spark, sf_dir, "documents")))


ORACLE["quality_ablations"] = f"""
with ledger as ({ORACLE["op10_quality_rules"]}),
rules(rule, bit) as (values ('short', 1), ('repeated_windows', 2), ('symbols', 4), ('not_alphabetic', 8), ('repeated_lines', 16), ('word_length', 32)),
policies(version, mask) as (values ('v1', 3), ('v2', 63))
select version, rule, count(*) as documents, count(*) filter ((fail_bits & mask) = 0) as kept,
  count(*) filter ((fail_bits & mask & bit) <> 0) as failing, count(*) filter ((fail_bits & mask) = bit) as kept_without
from ledger, policies, rules where (mask & bit) <> 0 group by version, rule"""


@_query
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("detections")


@_query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: what assistants say in ``conversations``; background: all ``documents``."""
    target = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    out = lm_scores(table(spark, sf_dir, "documents"), target)
    return out.withColumns({c: F.round(c, 9) for c in ("target_loss", "background_loss", "score")})


# '' is the unknown word, '^' the start of a text
ORACLE["op2_lm_scoring"] = r"""
with text as (
  select row_number() over () as r, true as own, doc_id, text from documents
  union all select row_number() over (), false, null, text from conversations where role = 'assistant'),
split as (select r, own, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as ws from text),
tok as (select r, own, unnest(ws) as w, generate_subscripts(ws, 1) as i from split),
uni as (select w, count(*) filter (not own) as t, count(*) filter (own) as b from tok group by w),
total as (select coalesce(sum(t), 0)::double as t, coalesce(sum(b), 0)::double as b from uni),
vocab as (select w, t, b from uni),
word as (
  select w, ln((t + 1) / (nt + v + 1)) as t, ln((b + 1) / (nb + v + 1)) as b
  from (select w, t, b from vocab union all select '', (select t from total) - sum(t), (select b from total) - sum(b) from vocab),
    (select count(*) as v from vocab), (select t as nt, b as nb from total)),
seq as (select r, own, i, coalesce(v.w, '') as w from tok left join vocab v on tok.w = v.w),
step as (select r, own, w, lag(w, 1, '^') over (partition by own, r order by i) as u from seq),
pair as (select u, w, count(*) filter (not own) as t, count(*) filter (own) as b from step group by u, w),
head as (select u, sum(t) as t, sum(b) as b from pair group by u),
kept as (
  select u, w, greatest(p.t - 0.75, 0) as t, greatest(p.b - 0.75, 0) as b from pair p),
rest as (
  select u, case when head.t > 0 then 1 - coalesce(k.t, 0) / head.t else 1 end as t, case when head.b > 0 then 1 - coalesce(k.b, 0) / head.b else 1 end as b
  from head left join (select u, sum(t) as t, sum(b) as b from kept group by u) k using (u)),
loss as (
  select r, count(*) as n,
    -avg(case when k.u is null then ln(rest.t) + word.t else ln(k.t / greatest(head.t, 1) + rest.t * exp(word.t)) end) as t,
    -avg(case when k.u is null then ln(rest.b) + word.b else ln(k.b / greatest(head.b, 1) + rest.b * exp(word.b)) end) as b
  from step s join word using (w) join head using (u) join rest using (u) left join kept k on k.u = s.u and k.w = s.w
  where own group by r)
select doc_id, coalesce(n, 0) as n_words, round(coalesce(t, 0), 9) as target_loss, round(coalesce(b, 0), 9) as background_loss, round(coalesce(t - b, 0), 9) as score
from split left join loss using (r) where own"""


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts all documents, deletes a tenth, revises another tenth (its language is added to
    the text), replays the deletes, and reports the totals."""
    docs = table(spark, sf_dir, "documents")
    rollup = Rollup(spark, scratch_path(spark, "op9-rollup"))
    none = F.lit(None).cast("string")
    batches = {
        "insert": docs.select("source", "lang", none.alias("old_text"), F.col("text").alias("new_text")),
        "delete": docs.where("doc_id % 10 = 3").select("source", "lang", F.col("text").alias("old_text"), none.alias("new_text")),
        "revise": docs.where("doc_id % 10 = 7").select("source", "lang", F.col("text").alias("old_text"), F.concat("text", F.lit(" "), "lang").alias("new_text")),
    }
    for name in ("insert", "delete", "revise", "delete"):
        rollup.commit(name, batches[name])
    return rollup.totals()


ORACLE["op9_token_counts"] = rf"""
with state as (
  select source, lang, case when doc_id % 10 = 7 then text || ' ' || lang else text end as text
  from documents where doc_id % 10 <> 3 and text is not null)
select source, lang, version, count(*) as n_docs, sum(n)::bigint as n_tokens from (
  select source, lang, 'words-1' as version, len({_WORDS}) as n from state
  union all
  select source, lang, 'pieces-2', len(regexp_extract_all(text, '[0-9A-Za-z]+|[^\x00-\x7F]+|[!-/:-@\[-`{{-~]')) from state)
group by all"""


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Tool traffic in the operator's wire format, made of the conversations' own texts: an
    assistant's turn calls a tool on its text, a user's turn after the first answers the call
    of the turn before.  Some calls are wrong on purpose, by the length of the text."""
    size = F.length("text")
    name = F.expr("case when length(text) % 13 = 0 then 'translate' else element_at(array('search', 'count_words', 'fetch_turn'), cast(length(text) % 3 + 1 as int)) end")
    late = F.when((F.col("turn") >= 2) & (size % 2 == 0), F.concat(F.lit("call_"), F.col("turn") - 2))
    search = F.when(size % 7 == 0, F.to_json(F.struct(size.cast("string").alias("limit"), F.col("text").alias("query")))).otherwise(F.to_json(F.struct(size.alias("limit"), F.col("text").alias("query"))))
    count = F.when(size % 11 == 0, F.to_json(F.struct(F.lit("word").alias("unit")))).otherwise(F.to_json(F.struct("text")))
    fetch = F.when(size % 5 == 0, F.to_json(F.struct(F.lit(True).alias("depth"), "turn"))).otherwise(F.to_json(F.struct("turn")))
    arguments = F.parse_json(F.when(size % 3 == 0, search).when(size % 3 == 1, count).otherwise(fetch))
    call = F.struct(late.alias("after"), arguments.alias("arguments"), F.concat(F.lit("call_"), "turn").alias("id"), name.alias("name"))
    answer = F.struct(F.col("text").alias("content"), F.concat(F.lit("call_"), F.col("turn") - 1).alias("tool_call_id"))
    is_call, is_answer = F.col("role") == "assistant", (F.col("role") == "user") & (F.col("turn") > 0)
    text = F.when(is_call, F.to_json(F.struct(F.array(call).alias("tool_calls")))).when(is_answer, F.to_json(answer)).otherwise(F.col("text"))
    return conversations.select("conv_id", "turn", F.when(is_answer, "tool").otherwise(F.col("role")).alias("role"), text.alias("text"))


@_query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and depths that do not apply are -1 here."""
    out = format_chats(tool_messages(table(spark, sf_dir, "conversations")), every=True)
    return out.withColumns({c: F.coalesce(c, F.lit(-1).cast("long")) for c in ("turn", "result_turn", "depth")}).fillna("", ["call_id", "errors"])


ORACLE["op5_chat_formatting"] = """
with recursive c as (
  select conv_id, turn, role, text, length(text) as n from conversations),
call as (
  select conv_id, turn, 'call_' || turn as call_id, case when turn >= 2 and n % 2 = 0 then 'call_' || (turn - 2) end as after,
    case when n % 13 = 0 then 'translate' when n % 3 = 0 then 'search' when n % 3 = 1 then 'count_words' else 'fetch_turn' end as name,
    case when n % 3 = 0 and n % 7 = 0 then json_object('limit', n::varchar, 'query', text) when n % 3 = 0 then json_object('limit', n, 'query', text)
      when n % 3 = 1 and n % 11 = 0 then json_object('unit', 'word') when n % 3 = 1 then json_object('text', text)
      when n % 5 = 0 then json_object('depth', true, 'turn', turn) else json_object('turn', turn) end as arguments,
    case when n % 13 = 0 then 'unknown_tool' when n % 3 = 0 and n % 7 = 0 then 'type:limit' when n % 3 = 1 and n % 11 = 0 then 'missing:text'
      when n % 3 = 2 and n % 5 = 0 then 'unknown:depth' else '' end as errors
  from c where role = 'assistant'),
result as (select conv_id, turn as result_turn, 'call_' || (turn - 1) as call_id, text as content from c where role = 'user' and turn > 0),
deep as (
  select a.conv_id, a.call_id, 0::bigint as depth from call a left join call b on a.conv_id = b.conv_id and a.after = b.call_id where b.call_id is null
  union all
  select a.conv_id, a.call_id, d.depth + 1 from call a join deep d on a.conv_id = d.conv_id and a.after = d.call_id),
linked as (
  select coalesce(a.conv_id, r.conv_id) as conv_id, a.call_id is not null as own, a.turn, r.result_turn, coalesce(a.call_id, r.call_id) as call_id, d.depth,
    case when a.call_id is null then 'orphan' when r.call_id is null then 'pending' else 'linked' end as status,
    a.errors, a.after, a.arguments, a.name, r.content, r.call_id is not null as answered
  from call a full join result r on a.conv_id = r.conv_id and a.call_id = r.call_id left join deep d on d.conv_id = a.conv_id and d.call_id = a.call_id),
field as (
  select *, list_filter([
    case when after is not null then '"after":' || to_json(after) end, case when own then '"arguments":' || arguments end,
    case when content is not null then '"content":' || to_json(content) end, '"conversation":' || conv_id, case when own then '"depth":' || depth end,
    case when errors <> '' then '"errors":' || to_json([errors]) end, '"id":' || to_json(call_id), case when own then '"name":' || to_json(name) end,
    case when answered then '"result_turn":' || result_turn end, '"status":' || to_json(status), case when own then '"turn":' || turn end], lambda x: x is not null) as fields
  from linked)
select conv_id, case when own then 'call' else 'result' end as kind, coalesce(turn, -1) as turn, coalesce(result_turn, -1) as result_turn, call_id,
  coalesce(depth, -1) as depth, status, coalesce(errors, '') as errors, own::bigint as n_calls, answered::bigint as n_results, '{' || array_to_string(fields, ',') || '}' as json
from field
union all
select conv_id, 'message', turn, -1, '', -1, 'message', '', 0, 0, json_object('content', text, 'conversation', conv_id, 'role', role, 'turn', turn)::varchar
from c where role = 'system' or role = 'user' and turn <= 0"""


@_query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_phrase_collocations"] = r"""
with d as (select row_number() over () as d, coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
piece as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from d)),
place as (select lang, w, unnest(range(1, len(w) + 1)) as i from piece),
gram as (select lang, k, list_slice(w, i, i + k - 1) as g from place, (values (1), (2), (3)) s(k) where i + k - 1 <= len(w)),
f as (select lang, k, g, count(*) as f from gram group by all),
total as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
cand as (select lang, k, g, f as a from f where k > 1 and f >= 10),
cut as (select c.*, h.k as first_words, h.f as l, t.f as r, ((c.a::hugeint * c.a * 1000000) // (h.f::hugeint * t.f))::bigint as score
    from cand c join f h on h.lang = c.lang and h.k < c.k and h.g = list_slice(c.g, 1, h.k)
    join f t on t.lang = c.lang and t.k = c.k - h.k and t.g = list_slice(c.g, h.k + 1, c.k)),
low as (select lang, k, g, a, l, r, score from cut qualify row_number() over (partition by lang, g order by score, first_words) = 1),
inside as (select lang, g, max(a) as around from (select lang, unnest([list_slice(g, 1, 2), list_slice(g, 2, 3)]) as g, a from cand where k = 3) group by all),
kept as (select low.*, array_to_string(low.g, ' ') as phrase from low left join inside using (lang, g) where around is null or 100 * around < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""


@_query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment(table(spark, sf_dir, "documents"), *paths)


@_query
def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))
