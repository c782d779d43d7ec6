"""The operators over the given tables, one query each, with the SQL that checks it if there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    forest,
    language,
    lengths,
    licenses,
    lines,
    manifest,
    negatives,
    packing,
    quality,
    rules,
    scoring,
    templates,
    toxicity,
)
from tideline.llm.common import documents, fold, table
from tideline.session import prepare

QUERIES = {}
ORACLES: dict[str, str] = {}

#: where the public vocabularies are
TOKENIZERS = "/opt/tokenizers"


def query(name: str, sql: str | None = None):
    def register(plan):
        QUERIES[name] = lambda spark, folder: plan(prepare(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


@query("op1_lm_scoring")
def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.scored(documents(spark, folder), fold(F.col("doc_id"), 5) == 1)


def license_sql() -> str:
    """The sentence table and the rules, one after the other, as DuckDB SQL."""
    known = ", ".join(f"'{k}': '{v}'" for k, v in licenses.SENTENCES.items())
    steps, hits, seq = [], [], "s0"
    for i, rule in enumerate((r for r in licenses.RULES if len(r.sentences) > 1), 1):
        pattern = rule.pattern()
        steps.append(
            f"s{i} as materialized (select *, array_to_string(list_transform(string_split(regexp_replace("
            f"{seq}, '({pattern})', chr(10) || '\\1' || chr(10), 'g'), chr(10)), lambda p: case when "
            f"regexp_full_match(p, '{pattern}') then repeat('-', length(p)) else p end), '') as s{i} "
            f"from {seq})"
        )
        hits.append(
            f"select doc_id, '{rule.name}' as \"rule\", '{rule.license}' as license, "
            f"len(regexp_extract_all({seq}, '{pattern}'))::bigint as n_matches, "
            f"(len(regexp_extract_all({seq}, '{pattern}')) * {len(rule.sentences)})::bigint "
            f"as n_sentences, (length(regexp_extract({seq}, '^(.*?){pattern}', 1)) + 1)::bigint "
            f"as first_sentence, length(replace(s0, '.', ''))::bigint as n_known "
            f"from {seq} where regexp_matches({seq}, '{pattern}')"
        )
        seq = f"s{i}"
    single = ", ".join(
        f"('{r.name}', '{r.license}', '{r.sentences}')" for r in licenses.RULES if len(r.sentences) == 1
    )
    hits.append(
        f"select doc_id, r.name as \"rule\", r.license, (length({seq}) - length(replace({seq}, r.mark, '')))"
        f"::bigint as n_matches, (length({seq}) - length(replace({seq}, r.mark, '')))::bigint as n_sentences, "
        f"instr({seq}, r.mark)::bigint as first_sentence, length(replace(s0, '.', ''))::bigint as n_known "
        f"from {seq} join (values {single}) as r(name, license, mark) on contains({seq}, r.mark)"
    )
    tag = licenses.TAG
    line = (
        f"case when starts_with(x, '{tag}') then array_to_string(list_transform(regexp_split_to_array("
        f"replace(substr(x, {len(tag) + 1}), ' or later', '{licenses.LATER}'), '{licenses.JOINED}'), "
        f"lambda p: coalesce(ids['{tag}' || p], '.')), '') else coalesce(ids[x], '.') end"
    )

    def each(lines: str) -> str:
        return f"array_to_string(list_transform({lines}, lambda x: {line}), '')"

    wrapped = ", ".join(
        (f"{each(f'l[:{n}]')} || " if n else "") + f"ids[array_to_string(l[{n + 1}:], ' ')]"
        for n in range(licenses.HEAD + 1)
    )
    return f"""
with blocks as (
  select doc_id, list_transform(regexp_split_to_array(lower(coalesce(text, '')), '{licenses.BREAK}'),
    lambda b: list_filter(list_transform(string_split(b, chr(10)),
      lambda x: trim(regexp_replace(x, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))), lambda x: x <> '')) as blocks
  from documents),
known as (select map {{{known}}} as ids),
s0 as materialized (
  select doc_id, array_to_string(list_transform(blocks, lambda l: case when len(l) > 1
    then coalesce({wrapped}, {each("l")}) else {each("l")} end), '') as s0
  from blocks cross join known),
{", ".join(steps)}
{" union all ".join(hits)}
"""


@query("op2_license_scan", license_sql())
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


@query("op3_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return forest.near_duplicates(documents(spark, folder), width=2, percent=80).drop("text_key")


@query("op4_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    return lengths.limits(lengths.histogram(documents(spark, folder), vocabulary))


@query("op5_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language.learn(docs.where(~held_out).select("text", "lang"))
    return language.predict(docs, model, held_out)


RULES_SQL = r"""
with words as (
  select doc_id, lang, source, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 6)) as i, w from words where len(w) >= 8),
grams as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as gram from windows),
twice as (
  select doc_id, i from (select *, count(*) over (partition by doc_id, gram) as n from grams)
  where n > 1),
covered as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by doc_id),
counts as (
  select doc_id, lang, source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_upper,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(c.n, 0) as n_repeat_words
  from words left join covered c using (doc_id)),
base as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    1000 * n_symbols // greatest(n_words, 1) as symbols,
    1000 * n_upper // greatest(word_chars, 1) as upper_case,
    1000 * n_dup_lines // greatest(n_lines, 1) as dup_lines,
    1000 * word_chars // greatest(n_words, 1) as word_length
  from counts),
vals as (
  select lang, source, m.measure, m.v - m.v % (1::bigint << greatest(length(bin(m.v)) - 7, 0)) as cell
  from (select lang, source, unnest([
    {'measure': 'symbols', 'v': symbols}, {'measure': 'upper', 'v': upper_case},
    {'measure': 'dup_lines', 'v': dup_lines}, {'measure': 'long_words', 'v': word_length},
    {'measure': 'short_words', 'v': word_length}]) as m from base where not base_failed)),
groups as (select distinct lang, source from vals),
own as (
  select lang, source, measure, count(*) as n, quantile_disc(cell, 0.25) as q25,
    quantile_disc(cell, 0.5) as q50, quantile_disc(cell, 0.75) as q75
  from vals group by all),
by_lang as (
  select lang, measure, count(*) as n, quantile_disc(cell, 0.25) as q25,
    quantile_disc(cell, 0.5) as q50, quantile_disc(cell, 0.75) as q75
  from vals group by all),
every as (
  select measure, count(*) as n, quantile_disc(cell, 0.25) as q25,
    quantile_disc(cell, 0.5) as q50, quantile_disc(cell, 0.75) as q75
  from vals group by all),
chosen as (
  select o.lang, o.source, o.measure,
    case when o.n >= 50 then o.q25 when l.n >= 50 then l.q25 else e.q25 end as q25,
    case when o.n >= 50 then o.q50 when l.n >= 50 then l.q50 else e.q50 end as q50,
    case when o.n >= 50 then o.q75 when l.n >= 50 then l.q75 else e.q75 end as q75
  from own o join by_lang l on o.lang is not distinct from l.lang and o.measure = l.measure
  join every e on o.measure = e.measure),
limits as (
  select lang, source,
    max(case measure when 'symbols' then q50 + greatest(8 * (q50 - q25), 100) end) as symbols_limit,
    max(case measure when 'upper' then q50 + greatest(8 * (q50 - q25), 350) end) as upper_limit,
    max(case measure when 'dup_lines' then q50 + greatest(8 * (q50 - q25), 400) end)
      as dup_lines_limit,
    max(case measure when 'long_words' then q50 + greatest(8 * (q50 - q25), 1000, q50 // 2) end)
      as long_words_limit,
    max(case measure when 'short_words' then q50 - greatest(8 * (q50 - q25), 1000, q50 // 2) end)
      as short_words_limit
  from chosen group by lang, source)
select b.doc_id, b.lang, b.source, b.n_words, b.word_chars, b.n_symbols, b.n_upper, b.n_lines,
  b.n_dup_lines, b.n_repeat_words, l.symbols_limit, l.upper_limit, l.dup_lines_limit,
  l.long_words_limit, l.short_words_limit, b.base_failed,
  not b.base_failed and not coalesce(b.symbols > l.symbols_limit, false)
    and not coalesce(b.upper_case > l.upper_limit, false)
    and not coalesce(b.dup_lines > l.dup_lines_limit, false)
    and not coalesce(b.word_length > l.long_words_limit, false)
    and not coalesce(b.word_length < l.short_words_limit, false) as kept
from base b left join limits l
  on b.lang is not distinct from l.lang and b.source is not distinct from l.source
"""


@query("op6_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 4) == 2
    found = quality.scored(documents(spark, folder), table(spark, folder, "labels"), ~held_out)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query("op7_quality_rules", RULES_SQL)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judged(documents(spark, folder))


@query("op8_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "benchmark")
    return templates.leaks(documents(spark, folder), items).drop("text_key")


@query("op9_toxicity")
def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = table(spark, folder, "labels")
    found = toxicity.scored(documents(spark, folder), labels, ~held_out, ["doc_id"])
    return found.select("row.doc_id", "score").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query("op10_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit(documents(spark, folder))


NEGATIVES_SQL = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as x
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding,
    lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    list_dot_product(a.x, b.x)::bigint as score
  from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
negatives as (
  select p.*, other_id as negative_id, score as negative_score, row_number() over (
    partition by p.anchor_id, positive_id order by score desc, other_id) as "rank"
  from positives p join scores s on p.anchor_id = s.anchor_id and not same
    and 100 * score between 30 * positive_score and 90 * positive_score)
select anchor_id, positive_id, "rank"::integer as "rank", negative_id, positive_score, negative_score
from negatives where "rank" <= 10
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label, vec_id = F.col("label"), F.col("vec_id")
    moved = F.when(vec_id % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)
    return negatives.mined(table(spark, folder, "embeddings"), moved, F.col("id") % 100 == 0)


LINES_SQL = """
with d as (
  select row_number() over () as n, doc_id, string_split(coalesce(text, ''), chr(10)) as lines
  from documents),
l as (
  select n, doc_id, unnest(lines) as line, unnest(range(len(lines))) as spot from d),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key from l),
common as (
  select line_key, max(doc_id) as keeper from keyed where length(line_key) >= 40
  group by line_key having count(distinct doc_id) >= 5),
marked as (
  select k.*, c.keeper is not null and c.keeper <> k.doc_id as gone
  from keyed k left join common c using (line_key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by spot) filter (not gone), '')) as kept_sha256
from marked group by n, doc_id
"""


@query("op12_line_dedup", LINES_SQL)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.deduplicated(documents(spark, folder).select("doc_id", "text"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return found.select("row.doc_id", "n_lines", "n_dropped", digest)


MANIFEST_SQL = """
with recursive crc as (
  select list_transform(range(256), lambda n: list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as steps),
fields as (
  select *, xor(list_reduce([4294967295]::bigint[] || list_transform(string_split(doc_id::varchar, ''),
      lambda x: ascii(x)::bigint), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])),
      4294967295) % 7 = 0 as tampered,
    list_transform([doc_id::varchar, source, lang], lambda x:
      coalesce(octet_length(encode(x)) || ':' || x, '-')) as before,
    coalesce(octet_length(encode(text)) || ':' || text, '-') as body
  from documents cross join crc),
leaves as (
  select doc_id, lang, sha256(array_to_string(before, '')
      || coalesce(length(n_chars::varchar) || ':' || n_chars, '-') || body) as leaf,
    sha256(array_to_string(before, '')
      || coalesce(length((n_chars + tampered::int)::varchar) || ':' || (n_chars + tampered::int), '-')
      || body) as probe
  from fields),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos
  from leaves),
nodes as (
  select lang, 0 as level, pos, leaf as node, count(*) over (partition by lang) as n from placed
  union all
  select lang, level + 1, pos // 2, sha256(string_agg(node, '' order by pos)), (any_value(n) + 1) // 2
  from nodes where n > 1 group by lang, level, pos // 2),
subroots as (
  select lang, node, row_number() over (order by lang nulls first) - 1 as pos from nodes where n = 1),
tops as (
  select 0 as level, pos, node, count(*) over () as n from subroots
  union all
  select level + 1, pos // 2, sha256(string_agg(node, '' order by pos)), (any_value(n) + 1) // 2
  from tops where n > 1 group by level, pos // 2),
root as (select node as root from tops where n = 1),
climb as (
  select doc_id, lang, leaf, pos as place, 0 as level, pos, probe as node, '' as proof, false as upper
  from placed
  union all
  select c.doc_id, c.lang, c.leaf, c.place, case when p.n > 1 then c.level + 1 when c.upper then c.level else 0 end,
    case when p.n > 1 then c.pos // 2 else s.pos end,
    case when p.n = 1 then c.node when sib.node is null then sha256(c.node)
      when c.pos % 2 = 0 then sha256(c.node || sib.node) else sha256(sib.node || c.node) end,
    c.proof || case when p.n > 1 then coalesce(sib.node, '') else '' end,
    c.upper or p.n = 1
  from climb c
  join (select lang, level, n, pos, node, false as upper from nodes
        union all select null, level, n, pos, node, true from tops) p
    on p.upper = c.upper and p.level = c.level and p.pos = c.pos
      and (p.upper or p.lang is not distinct from c.lang)
  left join (select lang, level, pos, node, false as upper from nodes
        union all select null, level, pos, node, true from tops) sib
    on sib.upper = c.upper and sib.level = c.level and sib.pos = xor(c.pos, 1)
      and (sib.upper or sib.lang is not distinct from c.lang)
  join subroots s on s.lang is not distinct from c.lang
  where not (c.upper and p.n = 1)),
ends as (
  select *, row_number() over (partition by doc_id, lang, leaf, place order by upper desc, level desc) as last
  from climb)
select e.doc_id, e.leaf, s.node as subroot, r.root, sha256(e.proof) as proof_sha256,
  e.node as folded_root, e.node = r.root as verified
from ends e join subroots s on s.lang is not distinct from e.lang cross join root r where e.last = 1
"""


@query("op13_merkle_manifest", MANIFEST_SQL)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest.proofs(documents(spark, folder), marked)
