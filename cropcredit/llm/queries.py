"""Queries of the training-data operators and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from cropcredit.llm import chat, conversation_trie, langid, merkle, mixing, ngram_join, packing, pivot_index, quality, spotsigs, token_files, toxicity, url_templates
from cropcredit.llm.common import materialize, read_table, shared_dir


def _remainder(n):
    return F.crc32(F.col("doc_id").cast("string")) % n


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op1_url_templates(spark, sf_dir):
    return url_templates.judge(read_table(spark, sf_dir, "pages"), RULES)


def op2_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_key")


def op4_token_files(spark, sf_dir, end_id=1, vocab=49_408):
    import public_tokenizers

    path = token_files.new_path(shared_dir(spark))
    token_files.write_ids(read_table(spark, sf_dir, "documents"), path,
                          public_tokenizers.path("word_bpe_49k.json"), end_id, vocab, specials=True)
    return token_files.read_documents(spark, path, vocab)


def op5_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    return quality.score(docs, model, "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


def op6_langid(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs)
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    return langid.label(docs.select("doc_id", "text"), model, "lang_pred", "score").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


TRICKY = "\\### Assistant: </turn> ok"


def op7_chat(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    tree = materialize(chat.linear_tree(c.unionByName(extra)), "tree")
    back = chat.parsed(materialize(chat.formatted(tree), "formatted"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op8_pivot_index(spark, sf_dir):
    return pivot_index.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_spotsigs(spark, sf_dir):
    return spotsigs.neighbours(read_table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    import public_tokenizers

    return packing.pack_documents(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024, specials=True)


def op11_conversation_trie(spark, sf_dir):
    turns = materialize(conversation_trie.ordered_turns(read_table(spark, sf_dir, "conversations")), "turns")
    turns, convs = conversation_trie.rebuilt(turns, 20, lambda c: F.crc32(c.cast("string")) % 4)
    return conversation_trie.trie(turns, convs)


def op12_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return toxicity.score(docs, model, "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.ACCEPT).cast("int").alias("predicted"))


def op13_merkle(spark, sf_dir):
    hit = F.coalesce(_remainder(2) == 0, F.lit(False))
    text = F.when(hit, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verified(read_table(spark, sf_dir, "documents"), merkle.leaf_digest(text=text))


#: Exact n-gram sets and similarities; components by recursion over the links.
NGRAM_JOIN_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
c AS (SELECT doc_id, ws, CASE WHEN len(ws) = 0 THEN 'e' || doc_id ELSE md5(array_to_string(ws, ' ')) END AS k FROM w),
cls AS (SELECT k, min(doc_id) AS class_id, count(*) AS copies, any_value(ws) AS ws FROM c GROUP BY k),
g AS (SELECT DISTINCT class_id, copies, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS s FROM cls),
sz AS (SELECT class_id, count(*) AS n FROM g GROUP BY 1),
rare AS (SELECT s FROM g GROUP BY s HAVING count(*) > 1),
p AS (SELECT a.class_id AS x, b.class_id AS y, any_value(b.copies) AS cy, count(*) AS i
  FROM (SELECT g.* FROM g SEMI JOIN rare USING (s)) a JOIN (SELECT g.* FROM g SEMI JOIN rare USING (s)) b
    ON a.s = b.s AND a.class_id <> b.class_id GROUP BY 1, 2),
l AS (SELECT x, y, cy FROM p JOIN sz a ON a.class_id = x JOIN sz b ON b.class_id = y WHERE i >= 0.8 * (a.n + b.n - i) - 1e-9),
reach AS (SELECT class_id AS x, class_id AS y FROM cls UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
grp AS (SELECT x, min(y) AS group_id FROM reach GROUP BY 1),
gain AS (SELECT x, sum(cy) AS gain FROM l GROUP BY 1)
SELECT c.doc_id, cls.class_id, CAST(cls.copies - 1 + coalesce(gain, 0) AS BIGINT) AS n_links, grp.group_id, c.doc_id = grp.group_id AS kept
FROM c JOIN cls USING (k) JOIN grp ON grp.x = cls.class_id LEFT JOIN gain ON gain.x = cls.class_id
"""


#: The same mixture with whole sorts in place of buckets. u/(1-u)*(1-p)/p ranks; peers are decided alike.
MIXING_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || coalesce(text, '')), 1, 13) AS BIGINT) AS h
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM d GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s0),
s2 AS (SELECT *, 3 * source_size / weight AS ratio FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER (ORDER BY ratio, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM s2),
s4 AS (SELECT source, source_size, n, CASE WHEN ratio < (SELECT arg_min(lev, ratio) FROM s3 WHERE lev <= ratio)
    THEN CAST(3 * source_size AS DOUBLE) ELSE (SELECT arg_min(lev, ratio) FROM s3 WHERE lev <= ratio) * weight END AS target,
  floor(source_size / n) AS mean FROM s3),
r AS (SELECT d.*, s4.source_size, s4.target, s4.mean, floor(1000 * size / (size + mean)) AS long
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source),
l AS (SELECT *, sum(CASE WHEN size > 0 THEN CAST(long AS BIGINT) * size ELSE 0 END) OVER (PARTITION BY source) / source_size AS lean,
  target / source_size AS rho FROM r),
c AS (SELECT *, CASE WHEN size > 0 THEN greatest(0.0, least(3.0, rho + least(rho, 3 - rho) * ((long - lean) / 1000))) ELSE rho END AS c FROM l),
p AS (SELECT *, floor(c) AS base, c - floor(c) AS p FROM c),
q AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN ((h + 0.5) / 4503599627370496.0) / (1 - (h + 0.5) / 4503599627370496.0) * ((1 - p) / p) END AS q,
  target - sum(base * size) OVER (PARTITION BY source) AS rest FROM p),
m AS (SELECT *, sum(CASE WHEN q IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q NULLS LAST, h RANGE UNBOUNDED PRECEDING) AS cum,
  sum(CASE WHEN q IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source, q, h) AS peers FROM q),
f AS (SELECT *, CAST(base + CASE WHEN q IS NOT NULL AND cum - peers < rest AND (cum <= rest OR cum - rest <= rest - (cum - peers)) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM m)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM f
"""


CHAT_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(role, '\\', '\\\\'), '<|', '<\\|') AS er, replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS et FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS LAST, role, text), '')) AS loss_sha256,
  CAST(sum(length(er) + length(et) + 8 + 8 + 7) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

#: All pairs within a label, by cosine in double precision.
EMBEDDING_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id
"""


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII string, bit by bit."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_transform(range(8), lambda k: (ascii(({text})[i]) >> k) & 1)))"
    step = "lambda c, b: CASE WHEN (xor(c, b) & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295, CAST({bits} AS BIGINT[])), {step}), 4294967295)"


def _merkle_sql() -> str:
    """Both kinds of trees level by level, then one walk from each leaf to the root."""
    def field(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text):
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('got')} AS received
  FROM (SELECT *, CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS got FROM documents)),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
  row_number() OVER () AS id FROM d),
up AS (SELECT source, 0 AS lvl, pos, n, leaf AS node FROM l
  UNION ALL SELECT source, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
sub AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, pos, n, subroot AS node FROM sub
  UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
kids AS (SELECT source, lvl, pos // 3 AS up, list(node ORDER BY pos) AS c FROM up WHERE n > 1 GROUP BY ALL),
kids2 AS (SELECT lvl, pos // 3 AS up, list(node ORDER BY pos) AS c FROM top WHERE n > 1 GROUP BY ALL),
walk AS (SELECT id, source, 0 AS lvl, pos, n, received AS node, '' AS sib FROM l
  UNION ALL SELECT id, w.source, w.lvl + 1, pos // 3, (n + 2) // 3,
    sha256(array_to_string(c[1:pos % 3], '') || node || array_to_string(c[pos % 3 + 2:], '')),
    sib || array_to_string(c[1:pos % 3], '') || array_to_string(c[pos % 3 + 2:], '')
  FROM walk w JOIN kids k ON k.source IS NOT DISTINCT FROM w.source AND k.lvl = w.lvl AND k.up = w.pos // 3 WHERE n > 1),
walk2 AS (SELECT w.id, 0 AS lvl, s.pos, s.n, w.node, w.sib FROM walk w JOIN sub s ON s.source IS NOT DISTINCT FROM w.source WHERE w.n = 1
  UNION ALL SELECT id, w.lvl + 1, pos // 3, (n + 2) // 3,
    sha256(array_to_string(c[1:pos % 3], '') || node || array_to_string(c[pos % 3 + 2:], '')),
    sib || array_to_string(c[1:pos % 3], '') || array_to_string(c[pos % 3 + 2:], '')
  FROM walk2 w JOIN kids2 k ON k.lvl = w.lvl AND k.up = w.pos // 3 WHERE n > 1)
SELECT doc_id, leaf, subroot, root.node AS root, sha256(sib) AS proof_sha256, w.node AS folded_root, w.node = root.node AS verified
FROM l JOIN walk2 w ON w.id = l.id AND w.n = 1 JOIN sub ON sub.source IS NOT DISTINCT FROM l.source, (SELECT node FROM top WHERE n = 1) root
"""


#: Every prefix of every rebuilt conversation under its own digest; subtree sums over the smallest members' prefixes.
TRIE_SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos, k, w FROM (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, {_crc32_sql('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, pos, k, w FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h
  UNION ALL SELECT conv_id, pos, k, w FROM c JOIN t USING (conv_id) WHERE pos > h),
s AS (SELECT conv_id, list(k ORDER BY pos) FILTER (k IS NOT NULL) AS ks, list(w ORDER BY pos) FILTER (k IS NOT NULL) AS ws
  FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id),
q AS (SELECT conv_id, l, depth, sha256(array_to_string(ks[1:depth], ' ')) AS key,
    CASE WHEN depth > 0 THEN sha256(array_to_string(ks[1:depth - 1], ' ')) END AS parent, coalesce(ws[depth], 0) AS w
  FROM (SELECT *, coalesce(len(ks), 0) AS l, unnest(range(coalesce(len(ks), 0) + 1)) AS depth FROM s)),
q2 AS (SELECT * REPLACE (coalesce(key, sha256('')) AS key, CASE WHEN depth = 1 THEN sha256('') ELSE parent END AS parent) FROM q),
n AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(w) AS w,
  sha256(coalesce(string_agg(CASE WHEN l = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends FROM q2 GROUP BY key, depth),
k AS (SELECT parent AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent),
o AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * w AS own FROM n LEFT JOIN k USING (key)),
b AS (SELECT q2.key, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved FROM o JOIN q2 ON q2.conv_id = o.conv_id AND q2.depth <= o.depth GROUP BY q2.key)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, o.ends AS ends_sha256
FROM o JOIN b USING (key) LEFT JOIN o p ON p.key = o.parent
"""


def _url_sql(rules=RULES, levels=16) -> str:
    """The template tree, one pair of common tables per level, for paths of at most ``levels`` segments (the tables have 3)."""
    cases = {"rule": [], "verdict": []}
    for text, verdict in sorted(rules, key=lambda r: -len(r[0])):
        host, slash, path = text.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + path}')"
        cases["rule"].append(f"WHEN {fits} THEN '{text}'")
        cases["verdict"].append(f"WHEN {fits} THEN '{verdict}'")
    u = url_templates
    sql = f"""
WITH a AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM a),
h AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
r AS (SELECT *, CASE {' '.join(cases['rule'])} END AS rule, CASE {' '.join(cases['verdict'])} END AS decided,
  list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: replace(x, '*', '%2A')) AS s FROM h),
p0 AS (SELECT *, '' AS template FROM r)"""
    for k in range(levels):
        sql += f""",
k{k} AS (SELECT host, template, s[{k + 1}] AS t, count(*) AS n FROM p{k} WHERE s[{k + 1}] IS NOT NULL GROUP BY ALL),
f{k} AS (SELECT * FROM (SELECT *, sum(n) OVER w AS pages, count(*) OVER w AS kinds FROM k{k} WINDOW w AS (PARTITION BY host, template))
  WHERE n * {u.LITERALS} >= pages AND NOT (kinds > 2 AND kinds * 2 > pages)),
p{k + 1} AS (SELECT p.* EXCLUDE (template), p.template || CASE WHEN s[{k + 1}] IS NULL THEN ''
  WHEN f.t IS NOT NULL THEN '/' || f.t ELSE '/*' END AS template
  FROM p{k} p LEFT JOIN f{k} f ON f.host = p.host AND f.template = p.template AND f.t = p.s[{k + 1}])"""
    return sql + f""",
t AS (SELECT host, template, count(*) FILTER (decided = 'allow') AS pos, count(*) FILTER (decided = 'block') AS neg FROM p{levels} GROUP BY ALL),
t2 AS (SELECT *, pos + neg AS n, (pos + 1) / (pos + neg + 2) AS share, regexp_replace(template, '/[^/*][^/]*((/\\*+)*)$', '/<>\\1') AS branch FROM t),
t3 AS (SELECT *, lag(n) OVER w AS n0, lag(share) OVER w AS s0 FROM t2 WINDOW w AS (PARTITION BY host, branch ORDER BY n > 0, share, template)),
t4 AS (SELECT *, ((n0 + 2) * s0 + (n + 2) * share) / ((n0 + 2) + (n + 2)) AS b FROM t3),
t5 AS (SELECT *, CASE WHEN n0 IS NOT NULL AND ((n0 > 0) <> (n > 0) OR abs(s0 - share) / sqrt(b * (1 - b) * (1 / (n0 + 2) + 1 / (n + 2))) >= {u.Z}) THEN 1 ELSE 0 END AS new FROM t4),
t6 AS (SELECT *, sum(new) OVER (PARTITION BY host, branch ORDER BY n > 0, share, template ROWS UNBOUNDED PRECEDING) AS merged FROM t5),
t7 AS (SELECT host, template, sum(pos) OVER (PARTITION BY host, branch, merged) AS mpos, sum(n) OVER (PARTITION BY host, branch, merged) AS mn,
  (sum(pos) OVER (PARTITION BY template) + {u.WEIGHT} * ((sum(pos) OVER () + 1) / (sum(n) OVER () + 2))) / (sum(n) OVER (PARTITION BY template) + {u.WEIGHT}) AS prior FROM t6),
t8 AS (SELECT host, template, (mpos + {u.WEIGHT} * prior) / (mn + {u.WEIGHT}) AS purity FROM t7)
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN purity >= {u.ACCEPT} THEN 'allow' ELSE 'block' END) AS verdict, template, purity
FROM p{levels} JOIN t8 USING (host, template)
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_url_templates, op2_mixing, op3_ngram_join, op4_token_files, op5_quality, op6_langid,
                                    op7_chat, op8_pivot_index, op9_spotsigs, op10_packing, op11_conversation_trie, op12_toxicity, op13_merkle)}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_templates": _url_sql(), "op2_mixing": MIXING_SQL, "op3_ngram_join": NGRAM_JOIN_SQL,
            "op7_chat": CHAT_SQL, "op8_pivot_index": EMBEDDING_SQL, "op11_conversation_trie": TRIE_SQL,
            "op13_merkle": _merkle_sql()}
