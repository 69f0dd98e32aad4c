"""Registered queries of the corpus operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.conversation_trie import prefix_trie
from freshet.llm.embedding_links import link_vectors
from freshet.llm.fingerprints import fingerprint_documents
from freshet.llm.interpolated_lm import score_documents
from freshet.llm.kd_shards import shard_documents
from freshet.llm.language_id import identify_languages
from freshet.llm.minhash import near_duplicates
from freshet.llm.mixing import mix_documents
from freshet.llm.packing import pack_documents
from freshet.llm.pii import find_personal_data
from freshet.llm.spelling_variants import spelling_variants
from freshet.llm.staging import documents
from freshet.llm.substring_dedup import repeated_passages
from freshet.llm.token_files import read_token_files, write_token_files
from freshet.session import scratch_dir


def vocabulary_file(name: str) -> str:
    """Where this machine keeps a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = vocabulary_file("word_bpe_49k.json")
    return pack_documents(spark, documents(spark, sf_dir), tokenizer, end_id=1, capacity=4096)


def crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))


def circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, documents(spark, sf_dir), percent=75, bands=50, rows=5)


def rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(spark, documents(spark, sf_dir))


def entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(spark, documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, limit=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def quartile_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark, documents(spark, sf_dir))


def cover_tree_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.98)


def gear_chunk_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark, documents(spark, sf_dir))


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    tokenizer = vocabulary_file("byte_bpe_50k.json")
    docs = documents(spark, sf_dir)
    write_token_files(spark, docs, path, tokenizer, vocabulary=50_257, end_id=2)
    read = read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark, documents(spark, sf_dir))


def whole_sequence_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie(spark, conversations).drop("k1", "k2")


def partenum_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark, documents(spark, sf_dir))


def kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(spark, documents(spark, sf_dir), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {
    "op1_best_two_fit_packing": best_two_fit_packing,
    "op2_crf_personal_data": crf_personal_data,
    "op3_circulant_minhash": circulant_minhash,
    "op4_rank_order_language": rank_order_language,
    "op5_entropy_mixing": entropy_mixing,
    "op6_gear_chunk_repeats": gear_chunk_repeats,
    "op7_quartile_fingerprints": quartile_fingerprints,
    "op8_cover_tree_links": cover_tree_links,
    "op9_kd_sharding": kd_sharding,
    "op10_token_id_files": token_id_files,
    "op11_deleted_interpolation": deleted_interpolation,
    "op12_whole_sequence_trie": whole_sequence_trie,
    "op13_partenum_spelling": partenum_spelling,
}

# Brute force: all pairs of distinct word sequences that share a shingle, by counting.
# Reachability grows one link a turn from every document, which suits a few hundred
# linked documents.
CIRCULANT_MINHASH = r"""
with recursive words as (
  select doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id,
         unnest(case when len(w) = 0 then []
                     when len(w) < 5 then [array_to_string(w, ' ')]
                     else list_transform(range(1, len(w) - 3),
                                         lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id
), links as (
  select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
  where 100 * c.c >= 75 * (x.n + y.n - c.c)
), reach(a, b) as (
  select a, b from links
  union
  select r.a, l.b from reach r join links l on l.a = r.b
), least_reached as (
  select a as doc_id, min(b) as b from reach group by a
)
select d.doc_id, coalesce(n, 0) as n_shingles,
       least(d.doc_id, coalesce(b, d.doc_id)) as component_id,
       d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) as kept
from documents d left join sizes using (doc_id) left join least_reached using (doc_id)
"""

COVER_TREE_LINKS = """
with recursive vectors as (
  select vec_id, label, embedding::double[] as e from embeddings
), usable as (
  select vec_id, label, e from vectors
  where label is not null and e is not null and len(list_filter(e, lambda x: x <> 0)) > 0
    and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0
), links as (
  select a.vec_id as a, b.vec_id as b
  from usable a join usable b
    on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) as (
  select a, b from links
  union
  select r.a, l.b from reach r join links l on l.a = r.b
), least_reached as (
  select a as vec_id, min(b) as b from reach group by a
), counted as (
  select a as vec_id, count(*) as n from links group by a
)
select v.vec_id, coalesce(n, 0) as n_links,
       least(v.vec_id, coalesce(b, v.vec_id)) as component_id,
       v.vec_id = least(v.vec_id, coalesce(b, v.vec_id)) as kept
from vectors v left join counted using (vec_id) left join least_reached using (vec_id)
"""

# CRC32 by its table of 256, made from the polynomial; ``crc32_sql`` folds a text's bytes.
CRC_TABLE = """
crc_steps(n, k, c) as (
  select n::bigint, 0, n::bigint from range(256) t(n)
  union all
  select n, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end
  from crc_steps where k < 8
), crc_table as (
  select list(c order by n) as crc from crc_steps where k = 8
)"""


def crc32_sql(text: str) -> str:
    """For code points below U+0800, in a select that has ``crc`` of ``crc_table``."""
    points = f"list_transform(range(1, length({text}) + 1), lambda i: unicode(({text})[i])::bigint)"
    octets = f"list_transform({points}, lambda p: case when p < 128 then [p] else [192 + (p >> 6), 128 + (p & 63)] end)"
    folded = (
        f"list_reduce(list_prepend(4294967295::bigint, flatten({octets})),"
        " lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))"
    )
    return f"xor({folded}, 4294967295)"


WHOLE_SEQUENCE_TRIE = f"""
with recursive {CRC_TABLE}, turns as (
  select conv_id, turn, coalesce(text, '') as text, coalesce(role, '') as role from conversations
  where conv_id is not null
), told as (
  select conv_id, turn, strlen(text) as bytes,
         strlen(role)::varchar || ':' || role || text as told from turns
), own as (
  select conv_id, list(told order by turn nulls first, md5(told)) as ts,
         list(bytes order by turn nulls first, md5(told)) as bs
  from told group by conv_id
), skips as (
  select conv_id, ts, bs, {crc32_sql("conv_id::varchar")} % 9 as h from own, crc_table
), rebuilt as (
  select c.conv_id, coalesce(b.ts[1:h], []) || c.ts[h + 1:] as ts,
         coalesce(b.bs[1:h], []) || c.bs[h + 1:] as bs
  from skips c left join own b on b.conv_id = c.conv_id - c.conv_id % 5
), steps as (
  select conv_id, ts, bs, unnest(range(0, len(ts) + 1)) as depth from rebuilt
), nodes as (
  select ts[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
         coalesce(max(case when depth > 0 then bs[depth] end), 0) as bytes,
         sha256(coalesce(string_agg(case when depth = len(ts) then conv_id::varchar end, ','
                                    order by conv_id), '')) as ends_sha256,
         max(len(ts)) = depth as leaf
  from steps group by ts[1:depth], depth
), below as (
  select path, (n_convs - 1) * bytes as saved, leaf, depth,
         unnest(range(0, depth + 1)) as upto from nodes
), sums as (
  select path[1:upto] as path, upto as depth, sum(saved)::bigint as saved_tokens,
         count_if(leaf)::bigint as n_leaves, count_if(depth = upto + 1)::bigint as n_children
  from below group by path[1:upto], upto
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n_children, n_leaves,
       saved_tokens, n.ends_sha256
from nodes n join sums s on s.path = n.path and s.depth = n.depth
  left join nodes p on p.depth = n.depth - 1 and p.path = n.path[1:n.depth - 1]
"""

# Near words share what is left when one letter is taken out of each, or of one of them.
PARTENUM_SPELLING = f"""
with recursive {CRC_TABLE}, runs as (
  select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) as run from documents
), lowered as (
  select translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run,
         coalesce(doc_id::varchar, '') || ':' || run as told, doc_id
  from runs where length(run) >= 7
), numbered as (
  select run, {crc32_sql("coalesce(doc_id::varchar, '') || ':' || run")} as h from lowered, crc_table
), spelled as (
  select case when h % 31 = 0
              then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
              else run end as word
  from numbered
), words as (
  select word, count(*) as n from spelled where length(word) >= 7 group by word having count(*) >= 2
), cut as (
  select word, i, substr(word, 1, (i - 1)::int) || substr(word, (i + 1)::int) as rest
  from (select word, unnest(range(1, length(word) + 1)) as i from words)
), near as (
  select a.word as a, b.word as b from cut a join cut b on a.i = b.i and a.rest = b.rest
  where a.word <> b.word
  union
  select a.word, b.word from words a join cut b on a.word = b.rest
  union
  select b.word, a.word from words a join cut b on a.word = b.rest
), judged as (
  select a, count(*) as n_near, first(b order by x.n desc, b) as other, max(x.n) as other_n
  from near join words x on x.word = b group by a
), formed as (
  select word, n, coalesce(n_near, 0) as n_near, case when other_n >= 10 * n then other end as form,
         case when other_n >= 10 * n then other_n end as form_n
  from words left join judged on a = word
), followed(word, root, step) as (
  select word, form, 1 from formed where form is not null
  union all
  select f.word, g.form, step + 1 from followed f join formed g on g.word = f.root
  where g.form is not null
), roots as (
  select word, arg_max(root, step) as root from followed group by word
)
select f.word, form, coalesce(root, f.word) as root, n, n_near, form_n
from formed f left join roots r on r.word = f.word
"""

ORACLES = {
    "op13_partenum_spelling": PARTENUM_SPELLING,
    "op12_whole_sequence_trie": WHOLE_SEQUENCE_TRIE,
    "op8_cover_tree_links": COVER_TREE_LINKS,
    "op3_circulant_minhash": CIRCULANT_MINHASH,
}
