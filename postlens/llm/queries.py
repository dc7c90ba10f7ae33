"""The registered queries of this subpackage, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.catalog.registry import query
from postlens.catalog.tables import table
from postlens.llm import (
    bpe,
    chat_format,
    conversation_trie,
    exact_dedup,
    hard_negatives,
    language_id,
    mixing,
    ngram_join,
    phrase_index,
    secrets,
    simhash,
    suffix_dedup,
    warc,
)

VOCABULARY = "word_bpe_49k.json"
# Every source is to have the same share.
TARGETS = {f"src{i}": 1.0 for i in range(20)}

_OP1_SQL = r"""WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(n) AS text_sha256
FROM t WINDOW w AS (PARTITION BY n)"""


def vocabulary(path: str | None = None) -> str:
    """The vocabulary file's content, by default that of the installed public tokenizers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return bpe.read_definition(path)


@query("op1_exact_dedup", _OP1_SQL)
def op1(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op2_bpe")
def op2(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


@query("op3_simhash")
def op3(spark, sf_dir):
    return simhash.simhash(table(spark, sf_dir, "documents"))


@query("op3_near_copies")
def op3_near(spark, sf_dir):
    """The fingerprints near each query row; `op3_simhash` lists the rows of each fingerprint."""
    return simhash.near_copies(table(spark, sf_dir, "documents"))[0]


@query(
    "op4_warc",
    """SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
              translate(upper(list_aggregate(list_transform(range(0, 4), lambda i: lpad(to_base(CAST('0x' || substr(sha1(coalesce(html, '')), CAST(1 + 10 * i AS INTEGER), 10) AS BIGINT), 32), 8, '0')), 'string_agg', '')),
                        '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
              CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
              nullif(min(page_id) OVER w, page_id) AS refers_to
       FROM pages WINDOW w AS (PARTITION BY coalesce(html, ''))""",
)
def op4(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op5_mixing", mixing.mix_sql(TARGETS))
def op5(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), TARGETS)


@query("op6_suffix_dedup")
def op6(spark, sf_dir):
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


@query("op7_secrets")
def op7(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query("op8_language_id")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language_id.held_out()
    model = language_id.train(docs, ~held, F.col("doc_id"))
    scored = language_id.predict(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return scored.drop("text")


@query("op9_ngram_join")
def op9(spark, sf_dir):
    return ngram_join.link_classes(table(spark, sf_dir, "documents"))


@query("op10_chat_format")
def op10(spark, sf_dir):
    own = spark.createDataFrame(
        [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.format_conversations(rows.unionByName(own))


_OP11_SQL = r"""WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS head,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
             lambda s, b: list_reduce(list_prepend(xor(s, b), list_transform(range(0, 8), lambda i: 0::BIGINT)),
                                      lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM c JOIN t ON t.conv_id = c.head AND place < h
  UNION ALL SELECT conv_id, 1, place, role, text FROM c JOIN t USING (conv_id) WHERE place >= h
), whole AS (
  SELECT c.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, place) FILTER (place IS NOT NULL), []) AS turns
  FROM c LEFT JOIN rebuilt USING (conv_id) GROUP BY c.conv_id
), prefixes AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM whole),
members AS (SELECT conv_id, depth, turns[1:depth] AS node, len(turns) = depth AS ends FROM prefixes),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(node[depth].text)) END AS own,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT node[1:d] AS node, sum(own) AS saved, count(*) FILTER (childless) AS n_leaves
  FROM (SELECT node, own, children.n IS NULL AS childless, unnest(range(0, depth + 1)) AS d FROM nodes LEFT JOIN children USING (node)) GROUP BY 1
)
SELECT nodes.conv_id, nodes.depth, parents.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
       below.n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN below USING (node) LEFT JOIN children USING (node)
     LEFT JOIN nodes AS parents ON nodes.depth > 0 AND parents.node = nodes.node[1:nodes.depth - 1]"""


@query("op11_conversation_trie", _OP11_SQL)
def op11(spark, sf_dir):
    rows = conversation_trie.turns(table(spark, sf_dir, "conversations"))
    heads = F.col("conv_id") - F.col("conv_id") % 5
    length = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return conversation_trie.trie(conversation_trie.chains(conversation_trie.with_shared_heads(rows, heads, length, longest=8)))


_OP12_SQL = r"""WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), grams AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, phrase)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""


@query("op12_phrase_index", _OP12_SQL)
def op12(spark, sf_dir):
    return phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_near_matches")
def op12_near(spark, sf_dir):
    """Documents that have all words of a benchmark window within twice its length, in any order."""
    return phrase_index.near_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP13_SQL = """WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM q a, q c WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3"""


@query("op13_hard_negatives", _OP13_SQL)
def op13(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(table(spark, sf_dir, "embeddings"), label)
    mined = hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)
    return mined.drop("anchor_row", "positive_row", "negative_row")
