"""Registered queries of the operators, with production parameters over whole tables, and their DuckDB checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwright.llm import chat, collocations, decontaminate, divergence, html_text, jaccard_join, packing, posting_lists, quality, records, topk, toxicity, warc
from snapwright.llm.common import crc_remainder, prepare, scratch
from snapwright.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    items = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", items.alias("items_sha256"), "contaminated")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = crc_remainder("doc_id", 4) == 2
    scored = toxicity.score(docs, toxicity.train(docs, labels, learn=~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "archives")
    warc.archive(table(spark, sf_dir, "pages"), folder)
    back = warc.read_archives(spark, folder, with_data=False).filter("last")
    return back.select("page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A conversation of control strings only, named by the contract.
    hostile = spark.sql("select -1L as conv_id, id as turn, case id when 0 then 'user' else 'assistant' end as role, '</s>[INST] ok [/INST]' as text from range(2)")
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(hostile)
    folder = scratch(spark, "formatted")
    chat.write_formatted(told, folder)
    return chat.digests(chat.read_turns(chat.read_formatted(spark, folder)))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), capacity=2048, end_id=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copy_id", "n_links")


def op8_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), folder, end_id=2)
    return records.read_records(spark, folder, with_ids=False)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = crc_remainder("doc_id", 3) == 1
    scored = quality.score(docs, quality.train(docs, labels, learn=~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), min_docs=10, top_terms=10)


def op12_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, longest=4, top=2000)


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_text, op2_decontaminate, op3_toxicity, op4_warc, op5_chat, op6_packing, op7_jaccard_join, op8_records, op9_quality, op10_exact_top_k,
        op11_source_divergence, op12_posting_lists, op13_collocations,
    )
}

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op2_decontaminate": f"""
        with d as (select row_number() over () as r, doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
        i as (select item_id, {_WORDS.format("text")} as w from benchmark),
        g as (select item_id, unnest(case when len(w) < 10 then [w] else list_transform(range(1, len(w) - 8), lambda s: w[s:s + 9]) end) as gram
              from i where len(w) > 0),
        sizes as (select distinct len(gram) as n from g),
        places as (select r, n, w, unnest(range(1, len(w) - n + 2)) as s from d, sizes where len(w) >= n),
        h as (select distinct z.r, z.s, z.n, g.item_id from places z join g on z.w[z.s:z.s + z.n - 1] = g.gram),
        covered as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from h) group by r),
        listed as (select r, count(*) as n_items, string_agg(k, ',' order by k) as ids from (select distinct r, item_id::varchar as k from h) group by r)
        select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join covered using (r) left join listed using (r)""",
    "op4_warc": """
        with p as (select page_id, coalesce(html, '') as h from pages),
        q as (select page_id, octet_length(encode(h))::bigint as payload_bytes, sha256(h) as payload_digest from p),
        f as (select *, min(page_id) over (partition by payload_digest) as first from q)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 100 and page_id > first then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 100 and page_id > first then first end as refers_to
        from f""",
    "op5_chat": r"""
        with c as (
            select conv_id, turn, role, coalesce(text, '') as t from conversations
            union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        e as (select *, regexp_replace(replace(t, '\', '\\'), '(<|\[)(s>|/s>|INST\]|/INST\]|SYS\]|/SYS\]|ROLE\]|/ROLE\]|\|endoftext\|>)', '\1\\\2', 'g') as x from c),
        f as (select *, length(x) + case role when 'user' then 13 when 'system' then 11 when 'assistant' then 4 else 17 + length(role) end as n from e)
        select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' order by turn)) as turns_sha256,
               coalesce(sum(length(t)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(t, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
               (3 + sum(n))::bigint as formatted_chars
        from f group by conv_id""",
    "op7_jaccard_join": r"""
        with recursive d as (
            select doc_id, list_filter(string_split_regex(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
        s as (select doc_id, list_distinct(case when len(w) < 5 then [array_to_string(w, ' ')]
                     else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from d where len(w) > 0),
        x as (select doc_id, unnest(g) as gram from s),
        n as (select doc_id, len(g) as n from s),
        p as (select a.doc_id as a, b.doc_id as b, count(*) as common from x a join x b on a.gram = b.gram and a.doc_id <> b.doc_id group by 1, 2),
        l as materialized (select a, b, common, na.n as na, nb.n as nb from p join n na on na.doc_id = a join n nb on nb.doc_id = b
              where common * 9 >= 4 * (na.n + nb.n)),
        r as (select doc_id, doc_id as root from documents union select l.b, r.root from r join l on l.a = r.doc_id),
        same as (select a, min(b) as b from l where common = na and common = nb group by a),
        c as (select a, count(*) as n_links from l group by a)
        select doc_id, min(root)::bigint as class_id, least(doc_id, any_value(same.b))::bigint as copy_id, coalesce(any_value(n_links), 0)::bigint as n_links
        from r left join same on same.a = doc_id left join c on c.a = doc_id group by doc_id""",
    "op10_exact_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as e from embeddings
                   where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        q as (select vec_id as query_id, e as qe from v where vec_id % 20 = 0),
        s as (select query_id, vec_id, list_inner_product(qe::double[], e::double[])::bigint as score from q, v where vec_id <> query_id),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        select query_id, rank::integer as rank, vec_id, score from r where rank <= 20""",
    "op11_source_divergence": r"""
        with d as (select row_number() over () as i, coalesce(lang,'') as lang, coalesce(source,'') as source, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
        x as (select i, lang, source, unnest(w) as term from d),
        kept as materialized (select lang, term, count(*)::hugeint as n from x group by lang, term having count(distinct i)>=10),
        langs as materialized (select lang, sum(n) as total, count(*)::hugeint as v from kept group by lang),
        groups as materialized (select distinct lang, source from d),
        c as materialized (select lang, source, term, count(*)::hugeint as n from x group by all),
        dense as materialized (select g.lang, g.source, k.term, coalesce(c.n,0) as n, k.n as ln from groups g join kept k using (lang) left join c on c.lang=g.lang and c.source=g.source and c.term=k.term),
        s as (select lang, source, sum(n) as total from dense group by all),
        p as materialized (select z.lang, z.source, z.term, z.n, 1+(1000000000*(z.n+2))//(s.total+2*l.v) as p, 1+(1000000000*(z.ln+2))//(l.total+2*l.v) as q from dense z join s using (lang,source) join langs l using (lang)),
        pair as (select a.lang, a.source, b.source as item, sum((a.p-b.p)*(a.p-b.p)//(a.p+b.p)) as value from p a join p b on a.lang=b.lang and a.term=b.term and a.source<>b.source group by all),
        everypair as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pair.value,0)::bigint as value from groups a join groups b on a.lang=b.lang and a.source<>b.source left join pair on pair.lang=a.lang and pair.source=a.source and pair.item=b.source),
        t as (select lang, source, 'term' as part, term as item, ((p-q)*(p-q)//(p+q))::bigint as value from p where n>0 and p>q),
        r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (select * from everypair union all select * from t))
        select lang, source, part, item, value, rank::integer as rank from r where part='pair' or rank<=10""",
    "op13_collocations": r"""
        with p as (select coalesce(lang,'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[.,;:!?\x0A-\x0D]')) as piece from documents),
        w as materialized (select lang, list_filter(regexp_split_to_array(piece,'[\x20\x09]+'), lambda x: x <> '') as w from p),
        sizes as (select lang, sum(len(w))::bigint as n from w group by lang),
        f as materialized (select lang, m, g, count(*) as f from (select lang, m, unnest(list_transform(range(1, len(w)-m+2), lambda i: w[i:i+m-1])) as g from w, (values (1),(2),(3),(4)) as s(m) where len(w)>=m) group by lang, m, g having count(*)>=30),
        c as (select * from f where m>1),
        longer as (select lang, g, max(f) as most from (select lang, f, unnest([g[1:m-1], g[2:m]]) as g from c where m>2) group by lang, g),
        cuts as (select c.lang, c.g, c.f as a, k, x.f as l, y.f as r, (2000000::hugeint*c.f)//(x.f+y.f) as score
         from (select *, unnest(range(1,m)) as k from c) c join f x on x.lang=c.lang and x.g=c.g[1:k] join f y on y.lang=c.lang and y.g=c.g[k+1:c.m]),
        best as (select * from cuts left join longer using (lang,g) where not coalesce(100*most>=80*a,false) qualify row_number() over (partition by lang,g order by score,k)=1),
        r as (select *, array_to_string(g,' ') as phrase, row_number() over (partition by lang order by score desc,a desc,array_to_string(g,' ')) as rank from best)
        select lang, rank, phrase, a, l, r, n, score::bigint as score from r join sizes using (lang) where rank<=2000""",
}
