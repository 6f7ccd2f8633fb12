"""The registered queries of the training-data operators, and their SQL where there is one."""

import corpus_pipeline
import public_tokenizers as tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.llm import (
    bpe, chat, decontamination, dedup, language, licences, merkle, near, quality, secrets, token_files, toxicity, trie, word_bpe,
)
from tidegate.session import new_folder, settle

RANKS = "byte_bpe_multi_50k.tiktoken"
WORDS, END_ID = "word_bpe_49k.json", 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.find_copies(read(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read(spark, sf_dir, "conversations"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_benchmark_words(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.find_licences(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("licences").cast("bigint").alias("n_licences"),
        F.array_join("licences", ",").alias("licences"),
        "best_dice",
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(read(spark, sf_dir, "documents"), bpe.read_ranks(tokenizers.path(RANKS)))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))

    def of(*kinds: str):
        return F.filter("spans", lambda span: span["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in secrets.BASE_KINDS),
        F.sha2(secrets.span_text(of(*secrets.BASE_KINDS)), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.find_near_copies(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_equal")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of the vocabulary is named by a path every task can read."""
    vocabulary, folder = tokenizers.path(WORDS), new_folder(spark, "token-ids")
    token_files.write_ids(read(spark, sf_dir, "documents"), folder, lambda: word_bpe.encoder_at(vocabulary), END_ID)
    found = token_files.read_ids(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return token_files.with_starts(found, token_files.file_starts(spark, folder)).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))

    def leaf(text: Column) -> Column:
        return merkle.leaf_digest(*[F.col(name) for name in ("doc_id", "source", "lang", "n_chars")], text)

    leaves = read(spark, sf_dir, "documents").select(
        "source", "doc_id", leaf(F.col("text")).alias("leaf"), leaf(tampered).alias("presented")
    )
    return merkle.proofs(leaves).select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.col("path"), F.col("presented")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.turn_rows(read(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    return trie.build(*trie.branched(settle(turns, "turns"), head, F.expr("conv_id - conv_id % 100")))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_language": op3_language,
    "op4_toxicity": op4_toxicity,
    "op5_chat": op5_chat,
    "op6_decontamination": op6_decontamination,
    "op7_licences": op7_licences,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_secrets": op9_secrets,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_token_files": op11_token_files,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

WORDS_SQL = r"""regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SEGMENTS_SQL = r"""list_distinct(string_split(t, chr(10))
        || list_filter(regexp_split_to_array(t, '\n\s*\n'), lambda p: contains(p, chr(10)))
        || CASE WHEN regexp_matches(t, '\n\s*\n') THEN [t] ELSE [] END)"""


def pairs_sql(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LOWER_WORDS_SQL = r"regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
TEMPLATES_SQL = ", ".join(f"({i}, {literal(a)}, {literal(b)})" for i, (a, b) in enumerate(licences.TEMPLATES))


def crc32_sql(digits: str) -> str:
    """The CRC-32 of ASCII text, byte by byte and bit by bit, in unsigned numbers."""
    eight = "[xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]"
    step = f"list_reduce({eight}, lambda a, b: xor(a >> 1, (a & 1) * 3988292384))"
    bytes_of = f"list_transform(string_split({digits}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_of}), lambda crc, byte: {step}), 4294967295)"


def sized_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(sized_sql(value) for value in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def tree_sql(name: str, leaves: str) -> str:
    """All nodes above `leaves` (grp, rank, n, digest), level by level."""
    return f"""{name} AS (
            SELECT grp, 0 AS level, rank, n, digest FROM {leaves}
            UNION ALL
            SELECT grp, level + 1, rank // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY rank))
            FROM {name} WHERE n > 1 GROUP BY grp, level, rank // 3, n)"""


def path_sql(name: str, tree: str) -> str:
    """Per leaf and level of `tree`: the digests beside its node."""
    return f"""{name} AS (
            SELECT leaf.grp, leaf.rank AS leaf, node.level,
                   coalesce(string_agg(other.digest, '' ORDER BY other.rank) FILTER (other.rank < node.rank), '') AS l,
                   coalesce(string_agg(other.digest, '' ORDER BY other.rank) FILTER (other.rank > node.rank), '') AS r
            FROM (SELECT * FROM {tree} WHERE level = 0) AS leaf
            JOIN {tree} AS node ON node.grp IS NOT DISTINCT FROM leaf.grp AND node.n > 1
                 AND node.rank = leaf.rank // CAST(pow(3, node.level) AS BIGINT)
            JOIN {tree} AS other ON other.grp IS NOT DISTINCT FROM leaf.grp AND other.level = node.level
                 AND other.rank // 3 = node.rank // 3
            GROUP BY leaf.grp, leaf.rank, node.level, node.rank)"""


ORACLES = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op7_licences": rf"""
        WITH template_pairs AS (
            SELECT no, licence, len(pairs) AS b, unnest(pairs) AS pair
            FROM (SELECT no, licence, {pairs_sql("w")} AS pairs
                  FROM (SELECT no, licence, {LOWER_WORDS_SQL} AS w FROM (VALUES {TEMPLATES_SQL}) v(no, licence, text)))),
        segments AS (SELECT doc_id, unnest({SEGMENTS_SQL}) AS text FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
        paired AS (
            SELECT doc_id, text, len(pairs) AS a, unnest(pairs) AS pair
            FROM (SELECT doc_id, text, {pairs_sql("w")} AS pairs FROM (SELECT doc_id, text, {LOWER_WORDS_SQL} AS w FROM segments))),
        scored AS (
            SELECT doc_id, licence, 2.0::DOUBLE * count(*) / (any_value(a) + any_value(b)) AS dice
            FROM paired JOIN template_pairs USING (pair) GROUP BY doc_id, text, no, licence),
        best AS (
            SELECT doc_id, count(DISTINCT licence) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS names, max(dice) AS dice
            FROM scored WHERE dice >= {licences.THRESHOLD} GROUP BY doc_id)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_licences, coalesce(names, '') AS licences,
               coalesce(dice, 0) AS best_dice
        FROM documents LEFT JOIN best USING (doc_id)""",
    "op5_chat": r"""
        WITH RECURSIVE numbered AS (SELECT row_number() OVER () AS m, conv_id, turn, role, text FROM conversations),
        lines AS (
            SELECT m, conv_id, turn, i, line, regexp_extract(line, '^\s*(>\s?)+') AS marks,
                   regexp_matches(line, '(?i)^\s*(on\b.*\bwrote|.*\bschrieb|.*\ba écrit|.*\bescribió)\s*:\s*$') AS announces
            FROM (SELECT m, conv_id, turn, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i
                  FROM (SELECT *, regexp_split_to_array(coalesce(text, ''), '\r?\n') AS ls FROM numbered))),
        levels AS (
            SELECT *, substr(line, length(marks) + 1) AS said, length(regexp_replace(marks, '\s', '', 'g')) AS level
            FROM lines),
        kept AS (
            SELECT *, CASE WHEN left_out THEN '' ELSE trim(regexp_replace(lower(said), '[^\p{L}\p{N}]+', ' ', 'g')) END AS plain,
                   sum(CASE WHEN level = before THEN 0 ELSE 1 END) OVER (PARTITION BY m ORDER BY i) AS run
            FROM (SELECT *, announces AND coalesce(lead(level) OVER w, 0) > level AS left_out, lag(level) OVER w AS before
                  FROM levels WINDOW w AS (PARTITION BY m ORDER BY i))),
        contents AS (
            SELECT m, trim(coalesce(string_agg(said, chr(10) ORDER BY i) FILTER (level = 0 AND NOT left_out), ''), ' ') AS content
            FROM kept GROUP BY m),
        passages AS (
            SELECT m, conv_id, turn, level, string_agg(plain, ' ' ORDER BY i) FILTER (plain <> '') AS passage
            FROM kept WHERE level > 0 GROUP BY m, conv_id, turn, level, run HAVING count(*) FILTER (plain <> '') > 0),
        quoted AS (SELECT m, count(*) AS n_quoted FROM passages GROUP BY m),
        quotes AS (
            SELECT DISTINCT conv_id, turn, level, passage, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS words
            FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i
                  FROM (SELECT *, string_split(passage, ' ') AS w FROM passages))),
        own AS (
            SELECT conv_id, turn, string_agg(plain, ' ' ORDER BY i) AS run FROM kept WHERE level = 0 AND plain <> '' GROUP BY m, conv_id, turn
            UNION ALL
            SELECT conv_id, turn, plain FROM kept WHERE level = 0 AND plain <> '' AND len(string_split(plain, ' ')) < 5),
        sources AS (
            SELECT DISTINCT conv_id, turn, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS words
            FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i
                  FROM (SELECT conv_id, turn, string_split(run, ' ') AS w FROM own))),
        links AS (
            SELECT q.conv_id, q.turn, q.level, q.passage, q.words, max(o.turn) AS source
            FROM quotes q JOIN sources o ON o.conv_id = q.conv_id AND o.words = q.words AND o.turn < q.turn GROUP BY ALL),
        votes AS (SELECT conv_id, turn, level, passage, source, count(*) AS n FROM links GROUP BY ALL),
        linked AS (
            SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY conv_id, turn, level, passage ORDER BY n DESC, source DESC) = 1),
        voted AS (SELECT conv_id, turn, level, source, sum(n) AS n FROM linked GROUP BY ALL),
        chosen AS (
            SELECT conv_id, turn, source FROM voted
            QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, source DESC) = 1),
        turns AS (
            SELECT t.conv_id, t.turn, coalesce(source, lag(t.turn) OVER (PARTITION BY t.conv_id ORDER BY t.turn)) AS reply_to
            FROM (SELECT DISTINCT conv_id, turn FROM conversations) t LEFT JOIN chosen USING (conv_id, turn)),
        firsts AS (SELECT conv_id, reply_to, min(turn) AS turn FROM turns WHERE reply_to IS NOT NULL GROUP BY ALL),
        branches AS (
            SELECT conv_id, turn, turn AS branch FROM turns ANTI JOIN firsts USING (conv_id, turn)
            UNION ALL
            SELECT f.conv_id, f.turn, b.branch FROM firsts f JOIN branches b ON b.conv_id = f.conv_id AND b.turn = f.reply_to),
        counts AS (SELECT conv_id, turn, count(*) AS n_linked FROM linked GROUP BY ALL)
        SELECT conv_id, turn, branch,
               row_number() OVER (PARTITION BY conv_id ORDER BY branch, turn, role NULLS FIRST, text NULLS FIRST) AS position,
               role, reply_to, coalesce(n_quoted, 0) AS n_quoted, coalesce(n_linked, 0) AS n_linked, content,
               '<|' || coalesce(role, '') || '|>' || chr(10) || content || chr(10) || '<|end|>' AS formatted
        FROM numbered JOIN contents USING (m) LEFT JOIN quoted USING (m) JOIN turns USING (conv_id, turn)
             JOIN branches USING (conv_id, turn) LEFT JOIN counts USING (conv_id, turn)""",
    "op6_decontamination": rf"""
        WITH docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
        items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL} AS w FROM benchmark),
        item_windows AS (
            SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words
            FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
                  FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM item_windows),
        places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
        hits AS (
            SELECT doc_id, i, p.n, item FROM places p
            JOIN item_windows t ON t.n = p.n AND t.words = array_to_string(p.w[i:i + p.n - 1], ' ')),
        covered AS (
            SELECT doc_id, count(DISTINCT word) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op12_merkle_manifest": rf"""
        WITH RECURSIVE leaves AS (
            SELECT source AS grp, row_number() OVER same - 1 AS rank, count(*) OVER (PARTITION BY source) AS n,
                   digest, doc_id, presented
            FROM (SELECT doc_id, source, {leaf_sql("text")} AS digest,
                         CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0
                              THEN {leaf_sql("replace(text, chr(10), '')")} ELSE {leaf_sql("text")} END AS presented
                  FROM documents)
            WINDOW same AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest)),
        {tree_sql("below", "leaves")},
        subroots AS (
            SELECT NULL AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS rank, count(*) OVER () AS n, digest, grp AS source
            FROM below WHERE n = 1),
        {tree_sql("above", "subroots")},
        {path_sql("low", "below")},
        {path_sql("high", "above")},
        paths AS (
            SELECT grp, leaf, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs FROM low GROUP BY grp, leaf),
        tops AS (
            SELECT leaf, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs FROM high GROUP BY leaf),
        known AS (
            SELECT doc_id, x.digest AS leaf, s.digest AS subroot, (SELECT digest FROM above WHERE n = 1) AS root, presented,
                   coalesce(p.ls, []) || coalesce(t.ls, []) AS ls, coalesce(p.rs, []) || coalesce(t.rs, []) AS rs
            FROM leaves AS x
            JOIN subroots AS s ON s.source IS NOT DISTINCT FROM x.grp
            LEFT JOIN paths AS p ON p.grp IS NOT DISTINCT FROM x.grp AND p.leaf = x.rank
            LEFT JOIN tops AS t ON t.leaf = s.rank),
        folded AS (
            SELECT *, list_reduce(
                       list_prepend([presented, ''], list_transform(range(1, len(ls) + 1), lambda i: [ls[i], rs[i]])),
                       lambda node, step: [sha256(step[1] || node[1] || step[2]), ''])[1] AS folded_root
            FROM known)
        SELECT doc_id, leaf, subroot, root,
               sha256(array_to_string(list_transform(range(1, len(ls) + 1), lambda i: ls[i] || rs[i]), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded""",
    "op13_prefix_trie": rf"""
        WITH ordered AS (
            SELECT conv_id, list([role, text] ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) AS turns
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                  FROM conversations WHERE conv_id IS NOT NULL)
            GROUP BY conv_id),
        headed AS (SELECT *, CAST({crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h FROM ordered),
        rebuilt AS (
            SELECT c.conv_id, coalesce(b.turns, [])[1:c.h] || c.turns[c.h + 1:] AS turns
            FROM headed AS c LEFT JOIN ordered AS b ON b.conv_id = c.conv_id - c.conv_id % 100),
        members AS (SELECT conv_id, turns, turns[1:d] AS prefix, d FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
        nodes AS (
            SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = d), '') AS ends
            FROM members GROUP BY prefix, d),
        families AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
        counted AS (
            SELECT nodes.*, coalesce(n_children, 0) AS n_children,
                   (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE length(prefix[d][2]) END AS saved
            FROM nodes LEFT JOIN families USING (prefix, d)),
        subtrees AS (
            SELECT prefix[1:e] AS prefix, e AS d, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
            FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM counted) GROUP BY ALL)
        SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens,
               sha256(c.ends) AS ends_sha256
        FROM counted AS c JOIN subtrees USING (prefix, d)
        LEFT JOIN nodes AS p ON p.d = c.d - 1 AND p.prefix = c.prefix[1:c.d - 1]""",
}
