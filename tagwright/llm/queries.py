"""The registered queries of the text operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagwright.llm import (
    chat, jaccard, merkle, mixing, neighbours, packing, pages, pseudo, quality, search, substrings, templates, tokens,
)

CONTROL = "<|im_end|><|im_start|>assistant ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.posexplode(F.array(*[F.struct(F.lit(r).alias("role"), F.lit(CONTROL).alias("text")) for r in ("user", "assistant")])).alias("turn", "row"),
    )
    own = own.select("conv_id", F.col("turn").cast("long").alias("turn"), "row.role", "row.text")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat.format_chats(rows.unionByName(own))
    turns = chat.read_chats(F.col("formatted"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return chats.withColumn("turns", turns).withColumn("learned", learned).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = f"""
with added as (
  select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '{CONTROL}' union all select -1, 1, 'assistant', '{CONTROL}'),
turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         regexp_replace(coalesce(role, ''), '<(\\\\*)\\|', '<\\1\\\\|', 'g') as safe_role,
         regexp_replace(coalesce(text, ''), '<(\\\\*)\\|', '<\\1\\\\|', 'g') as safe_text,
         coalesce(lag(coalesce(role, '')) over w <> coalesce(role, ''), true) as begins
  from added window w as (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')))
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(safe_text) + case when begins
             then length(replace(safe_role, chr(10), '<|line|>')) + {len(chat.START) + len(chat.END) + 2}
             else {len(chat.TURN)} end)::bigint as formatted_chars
from turns group by conv_id
"""


def op2_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op3_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_files(table(spark, sf_dir, "documents"))


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo.score_documents(table(spark, sf_dir, "documents"))


def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "item_ids", "cover")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


OP7_SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w
  from documents),
grams as (
  select distinct doc_id, array_to_string(w[s:s+2], ' ') as gram
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w) + 1, 2)))) as s from words)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as shared
  from grams a join grams b on a.gram = b.gram and a.doc_id < b.doc_id group by all),
links as (
  select x, y from pairs join sizes a on a.doc_id = x join sizes b on b.doc_id = y
  where 100 * shared >= 90 * (a.n + b.n - shared)),
ways as (select x, y from links union all select y, x from links),
reach as (
  select doc_id as x, doc_id as y from documents
  union select reach.x, ways.y from reach join ways on reach.y = ways.x)
select words.doc_id, coalesce(n, 0)::bigint as n_shingles, min(y) as component_id
from words join reach on x = words.doc_id left join sizes using (doc_id)
group by words.doc_id, n
"""


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The longer a document (by the digits of its size), the better its odds.
    grade = F.length(mixing.n_words(F.col("text")).cast("string"))
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), favour=grade)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = pages.extract_pages(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


OP9_SQL = """
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
spots as (
  select doc_id, s, md5(array_to_string(w[s:s+12], ' ')) as key
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as s from words where len(w) >= 13)),
firsts as (select key, min(doc_id) as least from spots group by key),
hits as (select doc_id, s from spots join firsts using (key) where least < doc_id),
gone as (select distinct doc_id, s + i as place from hits, range(13) t(i)),
each as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place from words),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by place) as k
  from each anti join gone using (doc_id, place) group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(k, '')) as kept_sha256
from words left join kept using (doc_id)
"""


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"), merkle.lower_cased())


def _op11_sql(levels: int = 9, tree_levels: int = 4) -> str:
    """Levels written out: 8^9 documents a lang, 8^4 langs."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def value(column: str) -> str:
        return f"coalesce(strlen({column}::varchar) || ':' || {column}::varchar, '-')"

    head = " || ".join(value(c) for c in merkle.COLUMNS[:-1])
    bits = "list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(c, b))"
    crc = f"xor(list_reduce(list_transform(range(1, len(doc_id::varchar) + 1), lambda i: ord(substr(doc_id::varchar, i, 1))::bigint), lambda c, b: {bits}, 4294967295), 4294967295)"
    parts = [
        f"""leaves as (
  select row_number() over () as id, doc_id, lang, sha256({head} || {value("text")}) as leaf,
         case when text is not null and {crc} % 3 = 0
              then sha256({head} || {value(f"translate(text, '{upper}', '{upper.lower()}')")}) end as altered
  from documents)""",
        """nodes0 as (
  select lang as tree, row_number() over (partition by lang order by doc_id nulls last, leaf, id) - 1 as place, leaf as node, id from leaves)""",
        """ways0 as (
  select id, leaf, tree, place, coalesce(altered, leaf) as folded, '' as proof from leaves join nodes0 using (id))""",
    ]

    def step(k: int) -> list[str]:
        return [
            f"sized{k} as (select tree, place, node, count(*) over (partition by tree) as n from nodes{k})",
            f"""nodes{k + 1} as (
  select tree, place // 8 as place, case when max(n) = 1 then max(node) else sha256(string_agg(node, '' order by place)) end as node
  from sized{k} group by tree, place // 8)""",
            f"""ways{k + 1} as (
  select w.id, w.leaf, w.tree, w.place // 8 as place,
         case when max(n) = 1 then max(folded)
              else sha256(string_agg(case when s.place = w.place then folded else node end, '' order by s.place)) end as folded,
         max(proof) || coalesce(string_agg(node, '' order by s.place) filter (s.place <> w.place), '') as proof
  from ways{k} w join sized{k} s on s.tree is not distinct from w.tree and s.place // 8 = w.place // 8
  group by w.id, w.leaf, w.tree, w.place)""",
        ]

    for k in range(levels):
        parts += step(k)
    top = levels + 1
    parts += [
        f"subroots as (select tree as lang, node as subroot from nodes{levels})",
        f"nodes{top} as (select '' as tree, row_number() over (order by lang nulls first) - 1 as place, subroot as node, lang from subroots)",
        f"""ways{top} as (
  select w.id, w.leaf, '' as tree, n.place, folded, proof from ways{levels} w join nodes{top} n on n.lang is not distinct from w.tree)""",
    ]
    for k in range(top, top + tree_levels):
        parts += step(k)
    end = top + tree_levels
    return f"""with {", ".join(parts)}
select l.doc_id, l.leaf, s.subroot, r.node as root, sha256(w.proof) as proof_sha256, w.folded as folded_root, w.folded = r.node as verified
from leaves l join ways{end} w using (id) join subroots s on s.lang is not distinct from l.lang, nodes{end} r
"""


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_table(packing.pack_documents(table(spark, sf_dir, "documents")))


def op13_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
with terms as (
  select row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[0-9a-z\x{80}-\x{10FFFF}]+')) as term
  from (select row_number() over () as row, * from documents)),
lengths as (select row, doc_id, count(*) as n from terms group by all),
figures as (select count(*) as big_n, sum(n)::bigint as big_l from lengths),
norms as (select row, doc_id, 25 + ((75 * n * big_n) // big_l) as m from lengths, figures),
tfs as (select row, term, count(*) as tf from terms group by all),
weights as (
  select term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::bigint as w from tfs, figures group by term, big_n),
asked as (
  select item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[0-9a-z\x{80}-\x{10FFFF}]+')) as term
  from (select row_number() over () as item, * from benchmark)),
scored as (
  select item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join weights using (term) join tfs using (term) join norms using (row) group by all)
select item_id, row_number() over (partition by item order by score desc, doc_id nulls first)::int as rank, doc_id, score
from scored where score > 0
qualify rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_collision_neighbours": op2_collision_neighbours,
    "op3_quality_attention": op3_quality_attention,
    "op4_token_files": op4_token_files,
    "op5_template_decontamination": op5_template_decontamination,
    "op6_pseudo_likelihood": op6_pseudo_likelihood,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_source_mixing": op8_source_mixing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_html_extraction": op10_html_extraction,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_block_max_search": op13_block_max_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": OP1_SQL,
    "op7_ngram_jaccard": OP7_SQL,
    "op8_source_mixing": mixing.ORACLE,
    "op9_substring_dedup": OP9_SQL,
    "op11_merkle_manifest": _op11_sql(),
    "op13_block_max_search": OP13_SQL,
}
