"""Chunking, retrieval, questions and conversations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.functions import text
from stationflow.operators import relational as rel
from stationflow.operators import retrieval as ret
from stationflow.operators.rollups import ordered_text
from stationflow.plans import questions as qa
from stationflow.session import durable, scratch_path
from stationflow.sources.tables import PartitionedTable, bucketed
from stationflow.workload.adapter import AS_OF, Data, sql
from stationflow.workload.registry import query

_CHUNKS = """select doc_id, source, i as chunk_no, substring(text, i * 990 + 1, 1000) as chunk_text from
(select *, unnest(range(cast(greatest(ceil((length(text) - 10) / 990), 1) as bigint))) as i from documents where length(text) > 0)"""


@query("concat_pages", "select doc_id, replace(text, chr(10), '') as text from documents")
def concat_pages(d: Data) -> DataFrame:
    """Lines stand for pages: joined without a separator they give the text without line ends."""
    lines = d.table("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("page_no", "text"))
    return ret.concat_pages(lines)


@query("chunk_fixed", f"select doc_id, chunk_no, chunk_text from ({_CHUNKS})")
def chunk_fixed(d: Data) -> DataFrame:
    chunks = ret.chunk_table(d.table("documents"), text.fixed_chunks(F.col("text")), ["doc_id"])
    return chunks.withColumn("chunk_no", F.col("chunk_no").cast("long"))


@query("chunk_recursive_rows")
def chunk_recursive_rows(d: Data) -> DataFrame:
    return ret.chunk_table(d.table("documents"), text.recursive_chunks()(F.col("text")), ["doc_id"])


@query(
    "chunk_recursive",
    r"""select doc_id, length(t) as chars, t <> '' as has_chunks, true as fitting, true as inside, true as starts, true as ends, true as covering
    from (select doc_id, regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') as t from documents)""",
)
def chunk_recursive(d: Data) -> DataFrame:
    """What must hold of a document's recursive chunks: at most 1000 characters each, pieces of the
    text, the first at its start and the last at its end, and together no fewer characters."""
    stripped = F.btrim(F.coalesce("text", F.lit("")), F.lit(" \n\t\x0b\f\r"))
    rows = d.table("documents").select("doc_id", stripped.alias("t"), text.recursive_chunks()(F.col("text")).alias("c"))
    some = F.size("c") > 0

    def solid(x: Column) -> Column:
        return F.length(reduce(lambda y, blank: F.replace(y, F.lit(blank)), " \n\t\x0b\f\r", x))

    total = F.aggregate("c", F.lit(0), lambda a, x: a + solid(x))
    return rows.select(
        "doc_id",
        F.length("t").cast("long").alias("chars"),
        some.alias("has_chunks"),
        F.forall("c", lambda x: (F.length(x) <= 1000) & (F.length(x) > 0)).alias("fitting"),
        F.forall("c", lambda x: F.contains(F.col("t"), x)).alias("inside"),
        (~some | F.startswith(F.col("t"), F.get("c", F.lit(0)))).alias("starts"),
        (~some | F.endswith(F.col("t"), F.get("c", F.size("c") - 1))).alias("ends"),
        (total >= solid(F.col("t"))).alias("covering"),
    )


@query(
    "chunk_records",
    f"""select 'chunk-' || sha256(concat(doc_id, chr(1), chunk_no, chr(1), chunk_text)) as id, doc_id, chunk_no, chunk_text,
    'uploaded_pdf' as category, source as file_name from ({_CHUNKS})""",
)
def chunk_records(d: Data) -> DataFrame:
    records = ret.chunk_records(d.table("documents"), "doc_id", "source", "uploaded_pdf")
    return records.select("id", "doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "metadata.*")


@query(
    "chunk_preview",
    f"""select doc_id, row, chars, greatest(total - 5, 0) as remaining from (select doc_id, cast(chunk_no + 1 as int) as row,
    length(chunk_text) as chars, count(*) over (partition by doc_id) as total from ({_CHUNKS})) where row <= 5""",
)
def chunk_preview(d: Data) -> DataFrame:
    """Lengths of the first five chunks of each document, and how many more there are."""
    chunks = ret.chunk_table(d.table("documents"), text.fixed_chunks(F.col("text")), ["doc_id"])
    lengths = chunks.select("doc_id", "chunk_no", F.length("chunk_text").cast("long").alias("chars"))
    return rel.preview(lengths, ["doc_id"], [F.asc("chunk_no")], 5).drop("chunk_no")


# Each label's mean vector asks for its two nearest vectors.

_CENTRES = """select label as query_id, list(v order by pos) as embedding from (select label, pos, avg(x) as v from
(select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as pos from embeddings) group by label, pos)
group by label"""
_NEAREST = f"""select query_id, vec_id, score, rank from (select query_id, vec_id, score,
cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from
(select query_id, vec_id, round(list_cosine_similarity(q.embedding, e.embedding::double[]), 9) as score
from ({_CENTRES}) q cross join embeddings e)) where rank <= 2"""


def _centres(d: Data) -> DataFrame:
    parts = d.table("embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg("x").alias("v"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
    vectors = means.groupBy("label").agg(F.transform(ordered, lambda p: p["v"]).alias("embedding"))
    return vectors.select(F.col("label").cast("long").alias("query_id"), "embedding")


@query("vector_topk", _NEAREST)
def vector_topk(d: Data) -> DataFrame:
    return ret.vector_topk(_centres(d), d.table("embeddings"), k=2)


@query(
    "assemble_context",
    f"""select query_id, coalesce(context, '{ret.NO_CONTEXT}') as context, coalesce(sources, '') as sources,
    coalesce(files, '') as files from (select distinct cast(label as bigint) as query_id from embeddings
    union all select -1) q left join (select n.query_id,
    string_agg('[' || source || ', topic: ' || lang || ']' || chr(10) || trim(text, ' '), chr(10) || chr(10) order by rank) as context,
    array_to_string(list_sort(list_distinct(list('- ' || source || ' (topic: ' || lang || ')'))), chr(10)) as sources,
    array_to_string(list_sort(list_distinct(list(source))), ', ') as files
    from ({_NEAREST}) n join documents on vec_id = doc_id group by n.query_id) using (query_id)""",
)
def assemble_context(d: Data) -> DataFrame:
    """Contexts of the nearest documents, and of a question that matches none."""
    centres = _centres(d)
    found = ret.vector_topk(centres, d.table("embeddings"), k=2)
    docs = d.table("documents").select(
        F.col("doc_id").alias("vec_id"),
        F.col("text").alias("chunk_text"),
        F.col("source").alias("file_name"),
        F.col("lang").alias("topic"),
    )
    asked = centres.select("query_id")
    none = asked.agg((F.min("query_id") * 0 - 1).alias("query_id"))
    return ret.assemble_context(asked.unionByName(none), found.join(docs, "vec_id"))


_RECORDS = f"""select 'chunk-' || sha256(concat(c.doc_id, chr(1), chunk_no, chr(1), chunk_text)) as id, chunk_text, source as file_name,
case c.doc_id % 3 when 0 then '007' when 1 then '010' else '7' end as namespace,
list_transform(embedding, lambda x, i: cast(x as double) * (1 + (chunk_no * i) % 5)) as embedding
from ({_CHUNKS}) c join embeddings e on c.doc_id = e.vec_id"""
_NEAREST_CHUNKS = f"""select query_id, id, score, chunk_text, file_name, rank from (select *, cast(row_number() over
(partition by query_id order by score desc, id) as int) as rank from (select query_id, id, chunk_text, file_name,
round(list_cosine_similarity(q.embedding, r.embedding), 9) as score from ({_CENTRES}) q cross join ({_RECORDS}) r
where namespace = '007')) where rank <= 2"""


@query(
    "retrieve_chunks",
    f"""select cast(query_id as bigint) as query_id, string_agg(id, ' ' order by rank) as ids,
    string_agg('[' || file_name || ', topic: General]' || chr(10) || trim(chunk_text, ' '), chr(10) || chr(10) order by rank) as context,
    array_to_string(list_sort(list_distinct(list(file_name))), ', ') as files from ({_NEAREST_CHUNKS}) group by query_id""",
)
def retrieve_chunks(d: Data) -> DataFrame:
    """Documents to chunks with derived ids, chunks under a namespace in a stored table, some of them
    ingested twice, the nearest of one namespace, and their context."""
    records = ret.chunk_records(d.table("documents"), "doc_id", "source", "uploaded_pdf")
    vectors = d.table("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    scaled = F.transform("embedding", lambda x, i: x.cast("double") * (1 + (F.col("chunk_no") * (i + 1)) % 5))
    space = F.when(F.col("doc_id") % 3 == 0, "007").when(F.col("doc_id") % 3 == 1, "010").otherwise("7")
    rows = records.join(vectors, "doc_id").select("id", space.alias("namespace"), scaled.alias("embedding"), "metadata")
    schema = "id string, namespace string, embedding array<double>, metadata struct<chunk_text:string,category:string,file_name:string>, bucket int"
    table = PartitionedTable(d.spark, scratch_path(d.spark, "vectors"), ["namespace", "bucket"], schema)
    table.overwrite(bucketed(rows.where("namespace <> '7'"), ["id"]))
    stored = table.upsert(bucketed(rows.where("namespace <> '010'"), ["id"]), ["namespace", "bucket", "id"])
    centres = _centres(d)
    found = ret.vector_topk(centres, stored.withColumnRenamed("id", "vec_id"), k=2, namespace="007")
    texts = stored.where("namespace = '007'").select(F.col("id").alias("vec_id"), "metadata.chunk_text", "metadata.file_name")
    matches = durable(found.join(texts, "vec_id").withColumn("topic", F.lit(None).cast("string")), "matches")
    ids = matches.groupBy("query_id").agg(ordered_text(F.col("rank"), F.col("vec_id"), " ").alias("ids"))
    return ret.assemble_context(centres.select("query_id"), matches).join(ids, "query_id").select("query_id", "ids", "context", "files")


@query(
    "date_pattern_extract",
    sql(
        r"""select question_id, coalesce(strftime(coalesce(
        try_strptime(nullif(regexp_extract(question, '\d{2}/\d{2}/\d{4}'), ''), '%d/%m/%Y'),
        try_strptime(nullif(regexp_extract(question, '\d{4}-\d{2}-\d{2}'), ''), '%Y-%m-%d'),
        try_strptime(nullif(regexp_extract(question, '\d{2}-\d{2}-\d{4}'), ''), '%d-%m-%Y')), '%Y-%m-%d'), 'unknown') as day
        from questions""",
        "questions",
    ),
)
def date_pattern_extract(d: Data) -> DataFrame:
    return d.questions.select("question_id", text.date_or_unknown(F.col("question")).alias("day"))


_PLACED = r"""select question_id, question, place from (select question_id, question, province_name as place,
row_number() over (partition by question_id order by length(province_name) desc nulls last, province_name) as pick
from questions left join provinces on regexp_matches(lower(question), '(^|[^a-z0-9_])' || lower(province_name) || '([^a-z0-9_]|$)'))
where pick = 1"""


@query("place_extract", sql(_PLACED, "questions", "provinces"))
def place_extract(d: Data) -> DataFrame:
    return qa.extract_places(d.questions, d.provinces)


_TYPED_RUNS = r"""select question_id, unnest(list_distinct(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]),
list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])))) as run from
(select question_id, list_filter(string_split_regex(lower(strip_accents(question)), '[^a-z0-9_]+'), lambda x: x <> '') as w from typed)"""


@query(
    "place_search",
    sql(
        f"""select question_id, question, place, edits from typed left join (select question_id, place, edits, row_number() over
        (partition by question_id order by edits, length(place) desc, place) as pick from (select question_id, province_name as place,
        levenshtein(run, name) as edits, name, run from ({_TYPED_RUNS}) join (select distinct province_name, array_to_string(list_filter(
        string_split_regex(lower(strip_accents(province_name)), '[^a-z0-9_]+'), lambda x: x <> ''), ' ') as name from provinces)
        on abs(length(run) - length(name)) <= 2) where edits <= case when length(name) >= 10 then 2 when length(name) >= 5 then 1 else 0 end
        and regexp_replace(run, '[^0-9]', '', 'g') = regexp_replace(name, '[^0-9]', '', 'g')) using (question_id) where coalesce(pick, 1) = 1""",
        "typed",
        "provinces",
    ),
)
def place_search(d: Data) -> DataFrame:
    """Places in questions with accents and misspelt names, held against every name by the SQL."""
    return qa.find_places(d.typed_questions, d.provinces).withColumn("edits", F.col("edits").cast("long"))


_FACTS = """select 'past' as kind, province_name as place, weather_date as answer_day, predicted_condition as condition, max_temperature
from classified union all select 'forecast', province_name, predicted_date, predicted_condition, max_temperature_c
from forecast join provinces using (province_id)"""


@query(
    "answer_questions",
    sql(
        rf"""select a.question_id, a.kind, a.place, a.day, f.answer_day, f.row, f.remaining, f.row is null as not_found, f.condition,
        round(f.max_temperature, 9) as max_temperature from (select question_id, place, day,
        case when day is null then case when regexp_matches(question, '(?i)\b(was|were|past|yesterday|history)\b') then 'past'
        when regexp_matches(question, '(?i)\b(will|forecast|tomorrow|next)\b') then 'forecast' else 'current' end
        when day <= date '{AS_OF}' then 'past' else 'forecast' end as kind
        from (select *, cast(coalesce(try_strptime(nullif(regexp_extract(question, '\d\d/\d\d/\d\d\d\d'), ''), '%d/%m/%Y'),
        try_strptime(nullif(regexp_extract(question, '\d\d\d\d-\d\d-\d\d'), ''), '%Y-%m-%d'),
        try_strptime(nullif(regexp_extract(question, '\d\d-\d\d-\d\d\d\d'), ''), '%d-%m-%Y')) as date) as day from ({_PLACED}))) a
        left join (
        select *, null::date as asked, 1 as row, cast(0 as bigint) as remaining from (select 'current' as kind, province_name as place,
        null::date as answer_day, weather_condition as condition, temperature_celsius as max_temperature from current_rows)
        union all select *, answer_day, 1, 0 from ({_FACTS})
        union all select kind, place, answer_day, condition, max_temperature, null::date, row, greatest(total - 3, 0) from (select *,
        cast(row_number() over (partition by kind, place order by answer_day) as int) as row, count(*) over (partition by kind, place) as total
        from ({_FACTS})) where row <= 3) f
        on a.kind = f.kind and a.place = f.place and a.day is not distinct from f.asked""",
        "questions",
        "current_rows",
        "classified",
        "forecast",
        "provinces",
    ),
)
def answer_questions(d: Data) -> DataFrame:
    """Every question against the stored current, past or forecast table it is about."""
    d = d.stored()
    asked = qa.with_kind(qa.extract_places(d.questions, d.provinces), AS_OF)
    past = d.daily_mart.drop("province_name")
    facts = durable(qa.answers(d.current.drop("province_name"), past, d.forecast, d.provinces), "facts")
    return qa.answer_questions(asked, facts).select(
        "question_id", "kind", "place", "day", "answer_day", "row", "remaining", "not_found", "condition",
        F.round("max_temperature", 9).alias("max_temperature"),
    )


@query(
    "conversation_history",
    """select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn) - 1 as place from conversations
    where role <> 'system'""",
)
def conversation_history(d: Data) -> DataFrame:
    """Turns with the place they came in, read off the order of the rows."""
    at = F.monotonically_increasing_id()
    rows = durable(ret.conversation_history(d.table("conversations")).select("conv_id", "turn", "role", "text").withColumn("_at", at), "history")
    start = rows.groupBy("conv_id").agg(F.min("_at").alias("_start"))
    return rows.join(start, "conv_id").withColumn("place", F.col("_at") - F.col("_start")).drop("_at", "_start")


@query(
    "conversation_list",
    """select conv_id, substring(cast(conv_id as varchar), 1, 8) as label, count(*) filter (where role <> 'system') as messages,
    arg_max(text, turn) filter (where role = 'user') as last_user_message from conversations group by conv_id""",
)
def conversation_list(d: Data) -> DataFrame:
    return ret.conversation_list(d.table("conversations"))
