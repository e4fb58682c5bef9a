"""The operators as registered queries over whole tables, with SQL twins where SQL can tell the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm import (
    decontamination, hard_negatives, html_text, importance, language_id, mixing, near_duplicates, pii, quality_classifier, quality_rules,
    segmentation, token_counts, warc,
)
from patchloom.llm.rows import table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of each document occur in windows of benchmark items?"""
    found = decontamination.benchmark_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return decontamination.digest(found)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which spans of each document are personal data?"""
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents"), ["doc_id"]))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, index the captures, and read back what the archives hold."""
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many unigram tokens does each document have?"""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), ["doc_id"]).select("row.*", "n_tokens")


def op5_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best segmentation of each document, how the next ones score, and whether decoding gives the text back."""
    found = segmentation.encoded(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("row.*", F.size("ids").cast("long").alias("n_pieces"), "ids", "score", "alternatives", "exact")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, by a model of the documents that are not held out."""
    documents = table(spark, sf_dir, "documents")
    out = language_id.held_out()
    model = language_id.learned(language_id.training_rows(documents.filter(~out)))
    found = language_id.identified(documents.withColumn("held_out", out), model, ["doc_id", "held_out"])
    return found.select("row.*", F.col("language").alias("lang_pred"), "score")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    return html_text.extracted(table(spark, sf_dir, "pages"), ["page_id", "url"]).select("row.*", "text", "n_chars")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents do the rules keep, each trusted as far as it agrees with the others?"""
    rows, _ = quality_rules.judged(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How good is each document, by a scorer trained on weak labels?"""
    rows, _, _ = quality_classifier.classified(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("row.*", "p_weak", "score", "good")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are near copies of each other?"""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents look most like the benchmark, by a weighted draw?"""
    found = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often does each document go into a mix of the sources at their weights?"""
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows of other labels come just below each anchor's positives?"""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_pii, op3_warc, op4_token_counts, op5_segmentation, op6_language_id, op7_html_text,
    op8_quality_rules, op9_quality_classifier, op10_near_duplicates, op11_importance, op12_mixing, op13_hard_negatives,
)}

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

TWINS = {
    "op1_decontamination": f"""
with d as (select doc_id, {_WORDS} w from documents),
b as (select item_id, {_WORDS} w from benchmark),
item_windows as (
  select distinct cast(item_id as varchar) item_id, least(len(w), 10) k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) s from b where len(w) > 0)),
sizes as (select distinct k from item_windows),
doc_windows as (
  select doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') win
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) s from d, sizes where len(w) >= k)),
hits as (select doc_id, item_id, k, s from doc_windows join item_windows using (k, win)),
words as (select doc_id, count(distinct p) n_hit from (select distinct doc_id, unnest(range(s, s + k)) p from hits) group by doc_id),
items as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) l
  from (select distinct doc_id, item_id from hits) group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join words using (doc_id) left join items using (doc_id)""",
    "op3_warc": """
with p as (select page_id, coalesce(html, '') h from pages),
c as (select *, max(page_id) over (partition by h) r,
  array_to_string([['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][
    strpos('0123456789ABCDEF', x)] for x in str_split(upper(sha1(h)), '')], '') bits from p)
select page_id, octet_length(encode(h))::bigint payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([cast(substr(bits, cast(5 * i + j + 1 as bigint), 1) as bigint)
    * (16 >> j) for j in range(0, 5)])::bigint, 1) for i in range(0, 32)], '') payload_digest,
  case when page_id = r then 'response' else 'revisit' end record_type,
  case when page_id = r then null else r end refers_to
from c""",
    "op13_hard_negatives": """
with r as (
  select vec_id, (case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end)::bigint l,
    list_transform(embedding, lambda x: floor(256 * x::double)) v
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id a, b.vec_id b, a.l = b.l same, list_inner_product(a.v, b.v)::bigint s
  from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select a, b, s from s where same qualify row_number() over (partition by a order by s desc, b) <= 5),
n as (
  select p.a, p.b, p.s ps, s.b nb, s.s ns, row_number() over (partition by p.a, p.b order by s.s desc, s.b) k
  from p join s on p.a = s.a and not s.same and 80 * p.s <= 100 * s.s and s.s <= p.s)
select a anchor_id, b positive_id, k::int rank, nb negative_id, ps positive_score, ns negative_score from n where k <= 5""",
    "op11_importance": f"""
with words as (select 'd' side, row_number() over () r, doc_id, {_WORDS} w from documents
  union all select 'b', -row_number() over (), null, {_WORDS} from benchmark),
features as (
  select side, r, array_to_string(w[i:i + k - 1], ' ') f
  from (select side, r, w, k, unnest(range(1, len(w) - k + 2)) i from words, (values (1), (2), (3)) ks(k))),
steps as (
  select list(list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) t
  from range(0, 256) n(i)),
spelled as (select f, hex(encode(f)) h from (select distinct f from features)),
buckets as (
  select f, xor(list_reduce(
    list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 10000 b
  from spelled, steps),
counts as (select b, count(*) filter (side = 'd') s, count(*) filter (side = 'b') t from features join buckets using (f) group by b),
totals as (select sum(s)::double s_all, sum(t)::double t_all from counts),
gains as (
  select b, floor(1000 * ln((t::double + 1) * (s_all + 10000) / ((s::double + 1) * (t_all + 10000))))::bigint gain from counts, totals),
weights as (select r, count(*) n, sum(gain)::bigint weight from features join buckets using (f) join gains using (b) where side = 'd' group by r),
scored as (
  select r, doc_id, len(w) n_words, coalesce(n, 0)::bigint n_features, coalesce(weight, 0)::bigint weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint score
  from words left join weights using (r) where side = 'd'),
ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last) k,
    5 * count(*) over (partition by n_words >= 20) // 100 n_drawn from scored)
select doc_id, n_features, weight, score, (case when n_words >= 20 and k <= n_drawn then k end)::bigint rank from ranked""",
    "op12_mixing": r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size from documents),
s as (
  select source, sum(size)::bigint source_size, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double w
  from d group by source),
ordered as (
  select *, row_number() over o k, coalesce(sum(2 * source_size) over (o rows between unbounded preceding and 1 preceding), 0)::double held,
    sum(w) over (o rows between current row and unbounded following) open, sum(source_size) over ()::double whole
  from s window o as (order by 2 * source_size / w, source nulls last)),
level as (
  select coalesce((1.5::double * whole - held) / open, 0) level from ordered
  where w * ((1.5::double * whole - held) / open) <= 2 * source_size order by k limit 1),
t as (select source, source_size, least(w * level, (2 * source_size)::double) target from s, level),
c as (
  select doc_id, size, d.source, source_size, target, case when source_size > 0 then target / source_size::double else 0 end copies,
    (('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint::double + 0.5) / 4503599627370496 u
  from d join t on d.source is not distinct from t.source),
odds as (
  select *, floor(copies)::bigint certain, copies - floor(copies) p,
    case when copies > floor(copies) then (u / (1 - u)) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) else 'inf'::double end odds from c),
run as (
  select *, coalesce(sum(size) over (partition by source order by odds, doc_id nulls last, size
      rows between unbounded preceding and 1 preceding), 0)::double before, sum(certain * size) over (partition by source)::double sure
  from odds)
select doc_id, size, source_size, target,
  (size * (certain + case when p > 0 and before + size / 2 < target - sure then 1 else 0 end))::bigint taken
from run""",
}
