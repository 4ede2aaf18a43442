"""The queries ``opN_<name>`` over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.alignment import align_tokenizers
from bidscope.llm.decontaminate import contaminated
from bidscope.llm.exact_dedup import exact_dedup
from bidscope.llm.langid import identify_language
from bidscope.llm.line_dedup import line_dedup
from bidscope.llm.near_dedup import near_dedup
from bidscope.llm.packing import pack
from bidscope.llm.quality import score_quality
from bidscope.llm.revisit import resolve_revisits
from bidscope.llm.spelling import spelling_variants
from bidscope.llm.substring_dedup import substring_dedup
from bidscope.llm.token_counts import token_counts
from bidscope.llm.toxicity import score_toxicity

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document; one row per document."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents; one row per document and item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines; one row per document."""
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in input in the captures' schema: each page once as a response and once as a
    not-modified answer half an hour later, with one of four kinds of validator."""
    kind = "case page_id % 4"
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url", "html", "1700000000 + page_id * 60 as s", "concat('day ', page_id % 365) as modified",
        "concat('\"', md5(coalesce(html, '')), '\"') as tag").selectExpr("explode(array("
        "  named_struct('capture_id', page_id * 2, 'url', url, 'ts', timestamp_seconds(s), 'status', 200, 'headers',"
        "    map('ETag', if(page_id % 4 = 1, null, tag), 'Last-Modified', modified, 'Content-Type', 'text/html',"
        "        'Date', cast(s as string)), 'payload', html),"
        "  named_struct('capture_id', page_id * 2 + 1, 'url', url, 'ts', timestamp_seconds(s + 1800), 'status', 304, 'headers',"
        f"    map('etag', {kind} when 0 then concat('W/', tag) when 2 then '\"new\"' end,"
        f"        'last-modified', {kind} when 1 then modified end,"
        "        'cache-control', 'max-age=60', 'content-type', 'none', 'date', cast(s + 1800 as string)),"
        "    'payload', cast(null as string)))) as c").select("c.*")


@query("op5_revisit_resolution", """
with p as (
 select page_id, url, html, 1700000000 + page_id * 60 as s, 'day ' || (page_id % 365) as modified,
  '"' || md5(coalesce(html, '')) || '"' as tag,
  regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as bare from pages),
c as (
 select *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), '^www\\.', ''), ':(80|443)$', '')
   || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') as place,
  list_sort(list_filter(string_split(regexp_extract(bare, '\\?(.*)$', 1), '&'),
                        lambda x: x <> '' and not starts_with(lower(x), 'utm_'))) as args from p),
k as (select *, place || case when len(args) > 0 then '?' || array_to_string(args, '&') else '' end as key from c),
pairs as (
 select r.page_id * 2 + 1 as capture_id, r.key, r.page_id as rp, r.s as rs, r.tag as rtag, r.modified as rmod,
  f.page_id * 2 as refers_to, f.page_id as fp, f.s as fs, f.tag as ftag, f.modified as fmod, f.html as fhtml,
  row_number() over (partition by r.page_id order by f.s desc nulls last, f.page_id desc) as n
 from k r left join k f on f.key = r.key and f.s < r.s + 1800 and f.html is not null),
o as (
 select *, case when refers_to is null then 'no_response'
   when rp % 4 in (0, 2) and fp % 4 <> 1 then case when rp % 4 = 0 and rtag = ftag then 'verified' else 'changed' end
   when rp % 4 = 1 then case when rmod = fmod then 'verified' else 'changed' end
   else 'unverified' end as outcome from pairs where n = 1)
select capture_id, key, refers_to, outcome,
 case when outcome = 'verified' then 'text/html' else 'none' end as content_type,
 case when outcome = 'verified' and rp % 4 = 1 then case when fp % 4 = 1 then null else ftag end
      when rp % 4 = 0 then 'W/' || rtag when rp % 4 = 2 then '"new"' end as etag,
 case when outcome = 'verified' and rp % 4 <> 1 then fmod when rp % 4 = 1 then rmod end as last_modified,
 cast(rs + 1800 as varchar) as date, 'max-age=60' as cache_control,
 case when outcome = 'verified' then sha256(fhtml) end as payload_sha256
from o""")
def op5_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-modified captures of the pages with the response they stand for; one row per revisit."""
    out = resolve_revisits(captures(spark, sf_dir))
    names = ("content-type", "etag", "last-modified", "date", "cache-control")
    return out.select("capture_id", "key", "refers_to", "outcome",
                      *(F.col("headers")[n].alias(n.replace("-", "_")) for n in names), "payload_sha256")


@query("op6_exact_dedup", """
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as t from documents),
     g as (select t, min(doc_id) as keep_id, count(*) as group_size from n group by t)
select n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id as kept, sha256(n.t) as text_sha256
from n join g on n.t = g.t""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts by chunk recipes; one row per document."""
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by an earlier 20-word window go; one row per document."""
    return substring_dedup(table(spark, sf_dir, "documents"), k=20)


def fold(n: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def _scored(scores: DataFrame, held_out: Column, least: float) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= least).cast("int").alias("predicted"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens; one row per piece."""
    return pack(table(spark, sf_dir, "documents"), vocabulary(), capacity=2048, separator=0)


@query("op7_near_dedup")
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents (five-word shingles, similarity 0.8); one row per document."""
    return near_dedup(table(spark, sf_dir, "documents"), shingle=5, threshold=0.8)


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its nearest labelled neighbours."""
    scores = score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"),
                           table(spark, sf_dir, "labels"), fold(5) != 0)
    return _scored(scores, fold(5) == 0, 0.3)


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by positive-unlabelled learning."""
    scores = score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"),
                            table(spark, sf_dir, "labels"), fold(3) != 1)
    return _scored(scores, fold(3) == 1, 0.7)


@query("op11_spelling_variants", """
with recursive
tab as (select list(v order by i) as crc from (
  select i, list_reduce(list_prepend(i, range(8)), lambda s, k: case when s & 1 = 1 then xor(s >> 1, 3988292384) else s >> 1 end) as v
  from range(256) as r(i))),
runs as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) as raw from documents),
lower_ as (select doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w from runs),
perdoc as (select doc_id, w, count(*) as c, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || w)) as x
  from lower_ where length(w) >= 6 group by doc_id, w),
hashed as (select w, c, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda p: cast('0x' || substr(x, p, 2) as bigint))),
    lambda s, b: xor(s >> 8, crc[(xor(s, b) & 255) + 1]))) as h from perdoc, tab),
thinned as (select c, case when h % 199 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word from hashed),
voc as (select word, cast(sum(c) as bigint) as n from thinned where length(word) >= 6 group by word having sum(c) >= 5),
places as (select word, n, unnest(range(1, length(word) + 1)) as i from voc),
holes as (select word, n, i, substr(word, 1, i - 1) || '?' || substr(word, i + 1) as hole from places),
cuts as (select distinct word, n, substr(word, 1, i - 1) || substr(word, i + 1) as cut from places),
near as (
  select a.word, a.n, b.word as other, b.n as m from holes a join holes b on a.hole = b.hole and a.word <> b.word
  union all select c.word, c.n, v.word, v.n from cuts c join voc v on v.word = c.cut
  union all select v.word, v.n, c.word, c.n from cuts c join voc v on v.word = c.cut),
best as (select word, n, count(*) as n_near, max(m) as top, min(other) filter (where m = most) as other from (
    select *, max(m) over (partition by word) as most from near) group by word, n),
told as (select v.word, v.n, coalesce(b.n_near, 0) as n_near, case when b.top >= 5 * v.n then b.other end as form,
    case when b.top >= 5 * v.n then b.top end as form_n from voc v left join best b on b.word = v.word),
chain as (select word, form as last, 1 as d from told where form is not null
  union all select c.word, t.form, c.d + 1 from chain c join told t on t.word = c.last where t.form is not null)
select t.word, t.form, coalesce(r.root, t.word) as root, t.n, t.n_near, t.form_n
from told t left join (select word, arg_max(last, d) as root from chain group by word) r on r.word = t.word""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart and the frequent form of each; one row per word."""
    return spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_language_id")
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by cross-parsing; one row per document."""
    out = identify_language(table(spark, sf_dir, "documents"), fold(5) != 0)
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "lang_pred", "score")


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and sentencepiece tokens of every document aligned; one row per document."""
    return align_tokenizers(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
