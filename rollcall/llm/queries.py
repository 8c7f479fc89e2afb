"""One query per operator over its whole tables, and the SQL that says the same where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    chunked_bpe,
    decontamination,
    language_id,
    language_model,
    line_dedup,
    near_dedup,
    nearest,
    packing,
    periodic_runs,
    secrets,
    substring_dedup,
    token_counts,
    vector_codes,
)
from rollcall.llm.shared import crc_mod, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = line_dedup.LineIndex.build(docs)
    kept = line_dedup.without_repeated_lines(docs, index)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_caches=True)


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        decontamination.hit_words().alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), min_percent=85)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(language_id.learning_rows(docs))
    return language_id.identify(docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op11_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = chunked_bpe.round_trip(table(spark, sf_dir, "documents"), path)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vector_codes.usable(table(spark, sf_dir, "embeddings"), "label")
    books = vector_codes.trained(vectors)
    rows = vector_codes.with_group_sums(vector_codes.coded(vectors, books, "label"), "label", "error", "label_error")
    return rows.select(
        "vec_id",
        F.array_join(F.transform("code", lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))), "").alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs.collapsed(periodic_runs.with_planted_tails(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"].alias("at"), r["period"].alias("of")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = rows.withColumn("most", F.array_max(order))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("most.at").alias("start"),
        F.col("most.length").alias("length"),
        F.col("most.of").alias("period"),
        F.expr("1000 * most.length div most.of").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    q.__name__: q
    for q in (
        op1_line_dedup,
        op2_language_model,
        op3_token_counts,
        op4_substring_dedup,
        op5_secret_scan,
        op6_packing,
        op7_nearest,
        op8_decontamination,
        op9_near_dedup,
        op10_language_id,
        op11_bpe_chunks,
        op12_vector_codes,
        op13_periodic_runs,
        pipeline,
    )
}

_LINES = """
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents
"""



def _nearest(k: int) -> str:
    """Each part with the nearest entry of book k; the least distance, then the least index."""
    return f"""
    select vec_id, label, part, v, best.entry as entry, best.far as far from (
        select p.vec_id, p.label, p.part, p.v,
            min({{'far': list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::bigint,
                'entry': b.entry}}) as best
        from pieces p join book{k} b on b.part = p.part group by all
    )"""


def _round(k: int) -> str:
    """Parts assigned to book k, and book k + 1 with the floors of their means."""
    return f"""
near{k} as ({_nearest(k)}),
means{k} as (
    select part, entry, list(((total - ((total % n) + n) % n) // n)::bigint order by pos) as v
    from (
        select part, entry, pos, sum(x) as total, count(*) as n
        from (select part, entry, unnest(v) as x, generate_subscripts(v, 1) as pos from near{k}) group by all
    ) group by part, entry
),
book{k + 1} as (select b.part, b.entry, coalesce(m.v, b.v) as v from book{k} b left join means{k} m using (part, entry))"""


ORACLES = {
    "op1_line_dedup": f"""
with lines as ({_LINES}),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
),
frequent as (
    select key, max(doc_id) as last_doc from keyed where length(key) >= 20 group by key
    having count(distinct doc_id) >= 3
),
judged as (
    select k.doc_id, k.pos, k.line, f.key is not null and k.doc_id <> f.last_doc as dropped
    from keyed k left join frequent f on k.key = f.key
)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from judged group by doc_id
""",
    "op4_substring_dedup": """
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents
),
windows as (
    select doc_id, pos, hash(array_to_string(words[pos : pos + 12], ' ')) as a, md5_number(array_to_string(words[pos : pos + 12], ' ')) as b
    from (select *, unnest(range(1, len(words) - 11)) as pos from words)
),
firsts as (select a, b, min(doc_id) as first_doc from windows group by a, b),
gone as (
    select distinct w.doc_id, w.pos + k.k as pos
    from windows w join firsts f on w.a = f.a and w.b = f.b and f.first_doc < w.doc_id, range(13) k(k)
),
kept as (
    select w.doc_id, w.word, w.pos, g.pos is not null as removed
    from (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos from words) w
    left join gone g on g.doc_id = w.doc_id and g.pos = w.pos
)
select d.doc_id, count(k.pos) as n_words, count(k.pos) filter (k.removed) as n_removed,
    sha256(coalesce(string_agg(k.word, ' ' order by k.pos) filter (not k.removed), '')) as kept_sha256
from words d left join kept k on k.doc_id = d.doc_id group by d.doc_id
""",
    "op8_decontamination": """
with doc_words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') as words from documents
),
item_words as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') as words from benchmark
),
windows as (
    select distinct item_id, least(len(words), 10) as size,
        array_to_string(words[pos : pos + least(len(words), 10) - 1], ' ') as key
    from (select *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as pos from item_words where len(words) > 0)
),
sizes as (select distinct size from windows),
starts as (
    select doc_id, size, pos, array_to_string(words[pos : pos + size - 1], ' ') as key
    from (select d.*, s.size, unnest(range(1, len(d.words) - s.size + 2)) as pos from doc_words d, sizes s)
),
found as (select s.doc_id, s.pos, s.size, w.item_id from starts s join windows w on s.key = w.key and s.size = w.size),
hit as (select doc_id, count(distinct pos + k) as n_hit from (select *, unnest(range(size)) as k from found) group by doc_id),
items as (
    select doc_id, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
    from (select distinct doc_id, item_id from found) group by doc_id
)
select d.doc_id, len(d.words) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
    sha256(coalesce(i.ids, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from doc_words d left join hit h using (doc_id) left join items i using (doc_id)
""",
    "op9_near_dedup": """
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as words from documents
),
shingles as (
    select distinct doc_id, array_to_string(words[pos : pos + least(len(words), 5) - 1], ' ') as shingle
    from (select *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as pos from words where len(words) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2
),
links as (
    select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
    where 100 * c.n >= 85 * (x.n + y.n - c.n)
),
reached(doc_id, other) as (
    select doc_id, doc_id from documents
    union
    select r.doc_id, l.b from reached r join links l on l.a = r.other
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, min(r.other) as component_id, d.doc_id = min(r.other) as kept
from documents d left join sizes s using (doc_id) join reached r on r.doc_id = d.doc_id
group by d.doc_id, s.n
""",
    "op12_vector_codes": f"""
with held as (
    select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
pieces as (
    select vec_id, label, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] as v
    from held, range(16) p(part)
),
book0 as (
    select part, row_number() over (partition by part order by vec_id) - 1 as entry, v
    from pieces where vec_id in (select vec_id from held order by vec_id limit 64)
),
{_round(0)},
{_round(1)},
near2 as ({_nearest(2)}),
codes as (
    select vec_id, any_value(label) as label, cast(sum(far) as bigint) as error,
        string_agg(lower(printf('%02x', entry)), '' order by part) as code
    from near2 group by vec_id
),
digest as (
    select sha256(string_agg(x, ',' order by part, entry, pos)) as d
    from (select part, entry, cast(unnest(v) as varchar) as x, generate_subscripts(v, 1) as pos from book2)
)
select vec_id, code, error::bigint as error, (sum(error) over (partition by label))::bigint as label_error, d as codebooks_sha256
from codes, digest
""",
}
