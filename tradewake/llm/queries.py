"""The registered queries of the operators on training data, each over a whole table, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    embeddings,
    language,
    line_dedup,
    merkle,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    spelling,
    token_counts,
    urls,
)
from .common import fold

Query = Callable[[SparkSession, str], DataFrame]

PII_KEY = corpus_pipeline.PII_KEY


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(_documents(spark, sf_dir))
    return classes.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def captures(pages: DataFrame) -> DataFrame:
    """The pages with a time of fetch, which the table lacks: within a year by the id."""
    hours = (F.col("page_id") % 365 * 24 + F.col("page_id") % 24).cast("int")
    return pages.select(
        "page_id", "url", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=hours)).alias("fetched_at")
    )


def list_entries(pages: DataFrame) -> DataFrame:
    """Three lists over the hosts, domains and first path segments that occur in the pages, dated by a digest."""
    parts = pages.select(urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path")).filter(
        F.col("host").isNotNull()
    )
    segment = F.split_part(F.lower(F.col("path")), F.lit("/"), F.lit(2))
    patterns = (
        parts.select(F.lit("hosts").alias("list"), F.col("host").alias("pattern"))
        .union(parts.select(F.lit("domains"), F.regexp_replace("host", r"^[^.]*\.", "")))
        .union(parts.filter(segment != "").select(F.lit("paths"), F.concat("host", F.lit("/"), segment)))
        .union(parts.select(F.lit("pages"), F.concat(F.lit("HTTP://*."), "host", F.lit(".:80"), "path", F.lit("/"))))
        .distinct()
    )
    digest = F.md5(F.concat_ws(" ", "list", "pattern").cast("binary"))
    code = lambda i: F.ascii(F.substring(digest, i, 1))
    first = (code(1) * code(2) + code(3)) % 300
    event = lambda days, action: F.struct(
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=days.cast("int"))).alias("listed_at"),
        action.alias("action"),
    )
    events = F.array(
        event(first, F.when(code(4) % 2 == 0, urls.BLOCK).otherwise(urls.ALLOW)),
        event(first + 60, F.lit(urls.REMOVE)),
        event(first + 90 + code(5) % 7, F.when(code(6) % 3 == 0, urls.ALLOW).otherwise(urls.BLOCK)),
    )
    return patterns.filter(code(7) % 3 == 0).select("list", "pattern", F.inline(events))


def op4_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = urls.verdicts(captures(pages), list_entries(pages))
    return found.withColumn("valid_from", F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss"))


_OP4_SQL = r"""
with pages_of as (
  select page_id, url, timestamp '2024-01-01' + to_hours((page_id % 365) * 24 + page_id % 24) as fetched_at,
         nullif(regexp_replace(lower(regexp_replace(regexp_replace(
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), '(:[0-9]*)?$', '')), '\.$', ''), '')
           as host,
         coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/') as path
  from pages
), patterns as (
  select 'hosts' as list, host as pattern from pages_of where host is not null
  union select 'domains', regexp_replace(host, '^[^.]*\.', '') from pages_of where host is not null
  union select 'paths', host || '/' || split_part(lower(path), '/', 2) from pages_of
        where host is not null and split_part(lower(path), '/', 2) <> ''
  union select 'pages', 'HTTP://*.' || host || '.:80' || path || '/' from pages_of where host is not null
), dated as (
  select *, md5(list || ' ' || pattern) as d from patterns
), coded as (
  select list, pattern, ascii(substr(d, 1, 1)) * ascii(substr(d, 2, 1)) + ascii(substr(d, 3, 1)) as c,
         ascii(substr(d, 4, 1)) as c4, ascii(substr(d, 5, 1)) as c5, ascii(substr(d, 6, 1)) as c6
  from dated where ascii(substr(d, 7, 1)) % 3 = 0
), events as (
  select list, pattern, timestamp '2024-01-01' + to_days((c % 300)::int) as listed_at,
         case when c4 % 2 = 0 then 'block' else 'allow' end as action from coded
  union all select list, pattern, timestamp '2024-01-01' + to_days((c % 300 + 60)::int), 'remove' from coded
  union all select list, pattern, timestamp '2024-01-01' + to_days((c % 300 + 90 + c5 % 7)::int),
         case when c6 % 3 = 0 then 'allow' else 'block' end from coded
), pointed as (
  select list, listed_at, action, regexp_replace(regexp_replace(lower(pattern), '^http://\*\.', ''), '\.:80/', '/') as pattern from events
), plain as (
  select list, listed_at, rtrim(regexp_replace(pattern, '/+', '/', 'g'), '/') as pattern,
         arg_max(action, case action when 'remove' then 0 when 'block' then 1 else 2 end) as action
  from pointed group by 1, 2, 3
), intervals as (
  select * from (select *, lead(listed_at) over (partition by list, pattern order by listed_at) as until from plain)
  where action <> 'remove'
), deepest as (
  select max(len(string_split(split_part(pattern, '/', 1), '.'))) as labels, max(len(string_split(pattern, '/'))) - 1 as parts
  from intervals
), labelled as (
  select *, string_split(host, '.') as labels,
         list_filter(string_split(lower(path), '/'), lambda x: x <> '') as parts
  from pages_of where host is not null
), domains as (
  select page_id, fetched_at, host, labelled.parts, labelled.labels, unnest(range(greatest(len(labelled.labels) - deepest.labels, 0), len(labelled.labels))) as i
  from labelled, deepest
), keys as (
  select page_id, fetched_at, array_to_string(domains.labels[i + 1:], '.') as domain, len(domains.labels) - i as depth,
         domains.parts, unnest(range(0, least(len(domains.parts), deepest.parts) + 1)) as n
  from domains, deepest
), asked as (
  select page_id, fetched_at, depth * 100000 + n as specific,
         domain || case when n = 0 then '' else '/' || array_to_string(parts[1:n], '/') end as key
  from keys
), best as (
  select page_id, list, pattern, action, listed_at,
         row_number() over (partition by page_id order by specific desc, (action <> 'block'), listed_at desc, list, pattern) as r
  from asked join intervals on key = pattern and fetched_at >= listed_at and (until is null or fetched_at < until)
)
select page_id, host, coalesce(action, 'none') as verdict, list, pattern, strftime(listed_at, '%Y-%m-%d %H:%M:%S') as valid_from
from pages_of left join (select * from best where r = 1) using (page_id)
"""


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    remainder = fold("doc_id", 3)
    model = language.fit_by_fold(docs, remainder != 1)
    found = language.with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.measured(_documents(spark, sf_dir))
    model = quality.fit_by_labels(rows, _table(spark, sf_dir, "labels"), fold("id", 5) != 0)
    return quality.with_score(rows, model).select(
        F.col("id").alias("doc_id"),
        F.coalesce(fold("id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.interleaved(_documents(spark, sf_dir))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


# The checksum byte by byte, with the usual table made from its polynomial.
_OP7_SQL = f"""
with steps as (
  select list_transform(range(256), lambda n: list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) as t
), texts as (
  select doc_id, source, hex(encode(coalesce(text, ''))) as h from documents
), sized as (
  select doc_id, source, length(h) // 2 + 1 as size, md5('{sharding.SEED}:' || coalesce(doc_id::varchar, '')) as key,
         xor(4294967295::bigint, list_reduce(list_concat([4294967295::bigint],
           list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i::int + 1, 2))::bigint)),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) as text_crc32
  from texts, steps
), ranked as (
  select *, (row_number() over (partition by source order by key, doc_id, size, text_crc32) - 0.5::double)
            / (count(*) over (partition by source))::double as fraction
  from sized
), placed as (
  select *, row_number() over (order by fraction, key, source nulls first, doc_id nulls first, size, text_crc32) - 1 as place,
         (count(*) over ()) // {sharding.SHARDS} as small, (count(*) over ()) % {sharding.SHARDS} as large
  from ranked
), dealt as (
  select *, case when place < large * (small + 1) then place // (small + 1)
                 else large + (place - large * (small + 1)) // greatest(small, 1) end as s
  from placed
)
select doc_id, size, text_crc32, 'rows' as law, s::int as shard, place - s * small - least(s, large) as slot,
       null::int as grown_shard, source
from dealt
"""


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return pii.pseudonyms(docs, PII_KEY)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.token_counts(docs).drop("text")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    proven = merkle.manifest(
        docs,
        group_col="lang",
        id_col="doc_id",
        columns=["doc_id", "source", "lang", "n_chars", "text"],
        changed={"text": lower_ascii(F.col("text"))},
        where=fold("doc_id", 3) == 0,
    )
    return proven.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", "doc_id")


# CRC-32 of a list of bytes, with the usual table made from its polynomial.
_CRC_STEPS = """steps as (
  select list_transform(range(256), lambda n: list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) as t
)"""


def _crc_sql(text: str) -> str:
    return f"""xor(4294967295::bigint, list_reduce(list_concat([4294967295::bigint],
      list_transform(range(length(hex(encode({text}))) // 2), lambda i: ('0x' || substr(hex(encode({text})), 2 * i::int + 1, 2))::bigint)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))"""


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_PART = "case when {0} is null then '-' else strlen({0}::varchar)::varchar || ':' || {0}::varchar end"
_LEAF = "sha256(" + " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_OP11_SQL = f"""
with recursive {_CRC_STEPS}, leaves as (
  select doc_id, lang, dense_rank() over (order by lang nulls first) - 1 as tree,
         row_number() over (partition by lang order by doc_id) - 1 as rank, {_LEAF.format(text="text")} as leaf,
         case when {_crc_sql("doc_id::varchar")} % 3 = 0
              then {_LEAF.format(text=f"translate(text, '{_UPPER}', '{_LOWER}')")} else {_LEAF.format(text="text")} end as other
  from documents, steps
), up as (
  select tree, 0 as level, rank, leaf as node, count(*) over (partition by tree) as n from leaves
  union all
  select tree, level + 1, rank // 8, sha256(string_agg(node, '' order by rank)), (max(n) + 7) // 8
  from up where n > 1 group by tree, level, rank // 8
), subroots as (select tree, node as subroot, max(level) over () as top from up where n = 1
), over_trees as (
  select 0 as level, tree as rank, subroot as node, (select count(*) from subroots) as n from subroots
  union all
  select level + 1, rank // 8, sha256(string_agg(node, '' order by rank)), (max(n) + 7) // 8
  from over_trees where n > 1 group by level, rank // 8
), root as (select node as root from over_trees where n = 1
), nodes as (
  select tree, level, rank, node from up where n > 1
  union all select -1, level, rank, node from over_trees where n > 1
), steps_up as (
  select distinct d.doc_id, d.tree, u.tree as of, u.level,
         case when u.tree = -1 then d.tree else d.rank end // (8::bigint ** u.level)::bigint as rank,
         case when u.tree = -1 then 1000 else 0 end + u.level as step
  from leaves d join (select distinct tree, level from nodes) u on u.tree = d.tree or u.tree = -1
), sides as (
  select s.doc_id, s.step, coalesce(string_agg(k.node, '' order by k.rank) filter (k.rank < s.rank), '') as before,
         coalesce(string_agg(k.node, '' order by k.rank) filter (k.rank > s.rank), '') as after
  from steps_up s join nodes k on k.tree = s.of and k.level = s.level and k.rank // 8 = s.rank // 8
  group by s.doc_id, s.step
), ways as (
  select doc_id, list(before || '|' || after order by step) as way, string_agg(before || after, '' order by step) as siblings
  from sides group by doc_id
), folded as (
  select doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) as proof_sha256,
         list_reduce(list_concat([other], coalesce(way, [])),
                     lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) as folded_root
  from leaves join subroots using (tree) left join ways using (doc_id), root
)
select *, folded_root = root as verified from folded
"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, sf_dir))


_OP12_SQL = f"""
with recursive {_CRC_STEPS}, runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) as run
  from documents
), counted as (select doc_id, run, count(*) as n from runs group by all
), coded as (
  select run, n, {_crc_sql("coalesce(doc_id::varchar, '') || ':' || run")} as code from counted, steps
), spelled as (
  select case when code % 31 = 0 then left(run, (code % length(run))::int) || substr(run, (code % length(run))::int + 2)
              else run end as word, n
  from coded
), words as (
  select word, sum(n)::bigint as n from spelled where length(word) >= 7 group by word having sum(n) >= 2
), cut as (
  select word, n, i, left(word, i::int) || substr(word, i::int + 2) as rest
  from (select word, n, unnest(range(length(word))) as i from words)
), pairs as (
  select a.word, a.n, b.word as near, b.n as near_n
  from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, a.n, b.word, b.n from cut a join words b on a.rest = b.word
  union select b.word, b.n, a.word, a.n from cut a join words b on a.rest = b.word
), best as (
  select *, row_number() over (partition by word order by near_n desc, encode(near)) as r,
         count(*) over (partition by word) as n_near
  from pairs
), forms as (
  select words.word, words.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * words.n then near end as form,
         case when near_n >= 10 * words.n then near_n end as form_n
  from words left join (select * from best where r = 1) using (word)
), ways as (
  select word, word as root, form as next from forms
  union all select ways.word, forms.word, forms.form from ways join forms on ways.next = forms.word
)
select word, form, root, n, n_near, form_n from forms join (select word, root from ways where next is null) using (word)
"""


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.without_repeated_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_OP13_SQL = f"""
with cut as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') as key from cut
), repeated as (
  select key, max(doc_id) as last from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), judged as (
  select keyed.*, last is not null and doc_id <> last as gone from keyed left join repeated using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (gone = false), '')) as kept_sha256
from judged group by doc_id
"""


_OP1_SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
), ok as (
  select * from v where label is not null and e is not null
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from ok a join ok b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.93
), reach as (
  select vec_id, vec_id as other from v union select reach.vec_id, links.b from reach join links on reach.other = links.a
), component as (select vec_id, min(other) as component_id from reach group by vec_id)
select v.vec_id, (select count(*) from links where a = v.vec_id) as n_links, component_id, v.vec_id = component_id as kept
from v join component using (vec_id)
"""

_QUERIES: dict[str, Query] = {
    "op1_embeddings": op1_embeddings,
    "op2_packing": op2_packing,
    "op3_simhash": op3_simhash,
    "op4_url_lists": op4_url_lists,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_pii": op9_pii,
    "op10_token_counts": op10_token_counts,
    "op11_merkle": op11_merkle,
    "op12_spelling": op12_spelling,
    "op13_line_dedup": op13_line_dedup,
    "pipeline": corpus_pipeline.run,
}

_SQL = {
    "op1_embeddings": _OP1_SQL,
    "op4_url_lists": _OP4_SQL,
    "op7_sharding": _OP7_SQL,
    "op11_merkle": _OP11_SQL,
    "op12_spelling": _OP12_SQL,
    "op13_line_dedup": _OP13_SQL,
    "pipeline": corpus_pipeline.ORACLE_SQL,
}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """SQL by query; the others are compared with plain versions in the tests."""
    return {name: sql for name, sql in _SQL.items() if sql is not None}
