"""The queries of this package over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import audit, bpe, chains, divergence, merkle, mixing, pagediff, permutation, pivots, plm, simhash, urlrules, warc
from voxloom.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "archives"))
    return warc.digests(warc.read_archives(manifest, payloads=False), "page_id", "long")


def tokenizer() -> str:
    """Path of the vocabulary file, which is installed on every worker."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digests(df: DataFrame) -> DataFrame:
    """Ids and decoded text as the numbers that stand for them."""
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return digests(bpe.round_trip(documents, "text", tokenizer()))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plm.score_corpus(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.extract(table(spark, sf_dir, "pages"))


#: The label columns as categories, in the chain's order.
CATEGORIES = {"unsuitable": "quality = 0", "toxic": "toxic = 1"}


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    chain = chains.fit(documents, table(spark, sf_dir, "labels"), CATEGORIES)
    scored = chains.score(documents, chain)
    return scored.select("doc_id", *(c for c in scored.columns if c.startswith("p_")), "toxic")


#: Host, path and verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = F.array(*(F.struct(*map(F.lit, r)) for r in URL_RULES)).cast("array<struct<host: string, path: string, verdict: string>>")
    rules = spark.range(1).select(F.inline(rules))
    judged = urlrules.judge(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


#: Columns of a document's leaf, in order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.when(hit, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    tampered = F.when(hit, merkle.leaf(*(F.col(c) for c in LEAF[:-1]), text))
    found = merkle.witnesses(table(spark, sf_dir, "documents"), LEAF, carry={"tampered": tampered})
    found = found.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("steps")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"))


QUERIES = [
    op1_mixing,
    op2_warc,
    op3_bpe,
    op4_embeddings,
    op5_likelihood,
    op6_simhash,
    op7_quality,
    op8_url_rules,
    op9_html,
    op10_toxicity,
    op11_merkle,
    op12_neighbours,
    op13_divergence,
]

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
#: Five hexadecimal digits of the hash are four letters of base 32.
_BASE_32 = " || ".join(
    f"substr({_LETTERS}, 1 + (('0x' || substr(hex, {5 * k + 1}, 5))::INTEGER >> {shift}) % 32, 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)

_SPACE = r"\x20\x09-\x0D"
#: Code points of each class, as a regular expression of the others.
_CLASS_SQL = {
    "lower": "a-z",
    "upper": "A-Z",
    "digit": "0-9",
    "space": _SPACE,
    "punctuation": r".,;:!?''\"()\[\]{}\-_/\\@^`~+=",
    "symbol": "#*$%&|<>",
    "control": r"\x00-\x08\x0E-\x1F\x7F",
    "wide": r"\x{80}-\x{10FFFF}",
}
_CLASS_COUNTS = ", ".join(
    f"length(text) - length(regexp_replace(text, '[{c}]', '', 'g')) AS {n}" for n, c in _CLASS_SQL.items()
)
_CLASS_LIST = "[" + ", ".join(_CLASS_SQL) + "]"


def _distance_sql(p: str, q: str) -> str:
    """Jensen-Shannon distance of bins with shares ``p`` and ``q``."""
    term = "coalesce(sum(CASE WHEN {0} > 0 THEN {0} * log2({0} / (({1} + {2}) / 2)) END), 0)"
    return f"sqrt(greatest(0, ({term.format(p, p, q)} + {term.format(q, p, q)}) / 2))"


def _leaf_sql(text: str) -> str:
    values = [*(f"{c}::VARCHAR" for c in LEAF[:-1]), text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


#: A tree of runs of 16 above rows (tree, pos, n, digest).
_TREE_SQL = """
    SELECT tree, 0 AS level, pos, n, digest FROM {0}
    UNION ALL
    SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM {1} WHERE n > 1 GROUP BY tree, level, pos // 16, n
"""
#: Digests beside each node's ancestor at each level, left and right of it.
_STEPS_SQL = """
    SELECT a.tree, a.pos, b.level,
        coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos // 16 ** b.level), '') AS left_ones,
        coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos // 16 ** b.level), '') AS right_ones
    FROM {0} a JOIN {1} b ON a.tree = b.tree AND b.n > 1
        AND b.pos // 16 = (a.pos // (16 ** b.level)::BIGINT) // 16
    GROUP BY a.tree, a.pos, b.level
""".replace("16 ** b.level)", "(16 ** b.level)::BIGINT)")


SQL: dict[str, str] = {
    "op11_merkle": f"""
        WITH RECURSIVE bits(doc_id, k, crc) AS (
            SELECT doc_id, 0, 4294967295::BIGINT FROM documents
            UNION ALL
            SELECT doc_id, k + 1, list_reduce([xor(crc, ascii(substr(doc_id::VARCHAR, k + 1, 1)))] || range(8),
                lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))
            FROM bits WHERE k < length(doc_id::VARCHAR)
        ),
        hit AS (
            SELECT doc_id FROM bits WHERE k = length(doc_id::VARCHAR) AND xor(crc, 4294967295) % 5 = 0
        ),
        leaves AS (
            SELECT doc_id, source, {_leaf_sql("text")} AS digest,
                CASE WHEN doc_id IN (FROM hit) THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS other
            FROM documents
        ),
        nodes AS (
            SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree,
                row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
                count(*) OVER (PARTITION BY source) AS n
            FROM leaves
        ),
        grown(tree, level, pos, n, digest) AS ({_TREE_SQL.format("nodes", "grown")}),
        groups AS (
            SELECT 0 AS tree, tree AS pos, (SELECT count(DISTINCT tree) FROM nodes) AS n, digest FROM grown WHERE n = 1
        ),
        over(tree, level, pos, n, digest) AS ({_TREE_SQL.format("groups", "over")}),
        own AS ({_STEPS_SQL.format("nodes", "grown")}),
        upper_steps AS ({_STEPS_SQL.format("groups", "over")}),
        steps AS (
            SELECT tree, pos, level, left_ones, right_ones FROM own
            UNION ALL
            SELECT nodes.tree, nodes.pos, 100 + level, left_ones, right_ones
            FROM nodes JOIN upper_steps u ON u.pos = nodes.tree
        ),
        lists AS (
            SELECT tree, pos, sha256(string_agg(left_ones || right_ones, '' ORDER BY level)) AS proof,
                list({{'l': left_ones, 'r': right_ones}} ORDER BY level) AS steps
            FROM steps GROUP BY tree, pos
        ),
        folded(tree, pos, k, digest) AS (
            SELECT tree, pos, 0, coalesce(other, digest) FROM nodes
            UNION ALL
            SELECT f.tree, f.pos, k + 1, sha256(steps[k + 1].l || f.digest || steps[k + 1].r)
            FROM folded f JOIN lists USING (tree, pos) WHERE k < len(steps)
        )
        SELECT n.doc_id, n.digest AS leaf, g.digest AS subroot, o.digest AS root,
            coalesce(l.proof, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = o.digest AS verified
        FROM nodes n JOIN groups g ON g.pos = n.tree JOIN over o ON o.n = 1
        LEFT JOIN lists l ON l.tree = n.tree AND l.pos = n.pos
        JOIN folded f ON f.tree = n.tree AND f.pos = n.pos AND f.k = coalesce(len(l.steps), 0)
    """,
    "op2_warc": f"""
        WITH hashed AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
            FROM pages
        ),
        firsts AS (SELECT hex, min(page_id) AS first FROM hashed GROUP BY hex)
        SELECT page_id, payload_bytes, {_BASE_32} AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM hashed JOIN firsts USING (hex)
    """,
    "op4_embeddings": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
                ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
        ),
        reached(a, b) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        ),
        components AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM components LEFT JOIN counts USING (vec_id)
    """,
    "op7_quality": f"""
        WITH texts AS (
            -- A language of its own stands for null.
            SELECT doc_id, coalesce(lang, chr(1)) AS lang, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda l: regexp_matches(l, '[^{_SPACE}]')) AS lines
            FROM documents
        ),
        classes AS (SELECT doc_id, lang, {_CLASS_COUNTS} FROM texts),
        windows AS (
            SELECT doc_id, unnest(range(1, len(words) - 1)) AS i,
                unnest(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) AS w
            FROM texts
        ),
        twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows),
        repeated AS (
            SELECT doc_id, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM twice WHERE n > 1) GROUP BY doc_id
        ),
        base AS (
            SELECT doc_id, lang, len(words) AS n_words,
                length(regexp_replace(text, '[{_SPACE}]', '', 'g')) AS word_chars, symbol AS n_symbols,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM texts JOIN (SELECT * EXCLUDE (lang) FROM classes) USING (doc_id) LEFT JOIN repeated USING (doc_id)
        ),
        said AS (
            SELECT doc_id, lang, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^{_SPACE}]+')) AS word
            FROM texts
        ),
        by_word AS (SELECT lang, word, count(*) AS n FROM said GROUP BY lang, word),
        languages AS (SELECT lang, sum(n) AS words FROM by_word GROUP BY lang),
        common AS (
            SELECT lang, word, n FROM by_word
            QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 50
        ),
        own AS (
            SELECT s.doc_id, s.lang, c.word, count(*) AS n FROM said s LEFT JOIN common c USING (lang, word)
            GROUP BY s.doc_id, s.lang, c.word
        ),
        bins AS (
            SELECT lang, word, n FROM common
            UNION ALL SELECT lang, NULL, any_value(words) - sum(n) FROM common JOIN languages USING (lang) GROUP BY lang
        ),
        word_distance AS (
            SELECT doc_id, {_distance_sql("p", "q")} AS by_words FROM (
                SELECT b.doc_id, coalesce(o.n, 0) / b.n_words AS p, r.n / l.words AS q
                FROM base b JOIN bins r USING (lang) JOIN languages l USING (lang)
                LEFT JOIN own o ON o.doc_id = b.doc_id AND o.word IS NOT DISTINCT FROM r.word
                WHERE b.n_words >= 150) GROUP BY doc_id
        ),
        spread AS (
            SELECT doc_id, lang, unnest({_CLASS_LIST}) AS n, generate_subscripts({_CLASS_LIST}, 1) AS class FROM classes
        ),
        class_shares AS (
            SELECT doc_id, lang, class, n, sum(n) OVER (PARTITION BY doc_id) AS chars,
                sum(n) OVER (PARTITION BY lang, class) / sum(n) OVER (PARTITION BY lang) AS q
            FROM spread
        ),
        class_distance AS (
            SELECT doc_id, {_distance_sql("p", "q")} AS by_class
            FROM (SELECT doc_id, n / chars AS p, q FROM class_shares SEMI JOIN languages USING (lang) WHERE chars >= 300)
            GROUP BY doc_id
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT base_failed AND coalesce(by_class, 0) <= 0.25 AND coalesce(by_words, 0) <= 0.37 AS kept
        FROM base LEFT JOIN class_distance USING (doc_id) LEFT JOIN word_distance USING (doc_id)
    """,
    "op13_divergence": rf"""
        WITH texts AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{audit.TERM}')) AS term
            FROM documents
        ),
        kept AS (
            SELECT lang, term, count(*)::HUGEINT AS n FROM texts GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 3
        ),
        langs AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        counts AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n FROM texts SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ),
        spread AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n, l.total AS lang_total, v,
                sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
            FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ),
        shares AS (
            SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (total + v)::HUGEINT AS p,
                1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v)::HUGEINT AS q
            FROM spread
        ),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ),
        items AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
        )
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
        FROM items QUALIFY part = 'pair' OR rank <= 200
    """,
    "op8_url_rules": rf"""
        WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULES_SQL}),
        rest AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0
                THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
        ),
        parts AS (
            SELECT page_id,
                translate(regexp_extract(rest, '^[^/?#]*'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ),
        ranked AS (
            SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
                row_number() OVER (PARTITION BY page_id
                    ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS rank
            FROM parts LEFT JOIN rules
                ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE rank = 1
    """,
}
