"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.decontam import contamination
from ledgerlake.llm.exact import exact_groups
from ledgerlake.llm.html import extract
from ledgerlake.llm.langid import identify
from ledgerlake.llm.lexical import build_index, search
from ledgerlake.llm.licenses import scan
from ledgerlake.llm.ngrams import near_groups
from ledgerlake.llm.packing import pack
from ledgerlake.llm.quality import classify
from ledgerlake.llm.repair import audit, damaged
from ledgerlake.llm.repeats import remove_repeats
from ledgerlake.llm.shards import shard_rows
from ledgerlake.llm.urls import Rule, judge


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of ``documents`` by block naming."""
    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: The contract's rules, in its order.
URL_RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
             Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens of ``documents`` in training sequences of several lengths."""
    return pack(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the co-trained views, learned from ``labels``."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License mentions of ``documents``."""
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the recurrent network over bytes."""
    return identify(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents``: components of the exact Jaccard join of 5-word shingles."""
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` that a repeated 100-byte string covers."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url by the trie of rules."""
    return judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's inferred wrapper."""
    return extract(table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` that lie in a ten-word window of a ``benchmark`` item."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation of ``conversations``."""
    rows = table(spark, sf_dir, "conversations")
    return audit(damaged(rows), convs=rows)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score highest for every ``benchmark`` item."""
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 24 shards by the ring, with bounds that leave their counts at most one apart."""
    return shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_license_scan": op3_license_scan,
    "op4_language_id": op4_language_id,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_html_extraction": op9_html_extraction,
    "op10_decontaminate": op10_decontaminate,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lexical_search": op12_lexical_search,
    "op13_sharding": op13_sharding,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE = {
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op6_ngram_jaccard": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k + 1, k + 5), ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS k FROM w WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * o >= 80 * (p.n + q.n - o)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT documents.doc_id AS doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
        FROM documents LEFT JOIN sizes ON documents.doc_id = sizes.doc_id
        JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON documents.doc_id = r.a
    """,
    "op7_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s
              FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 99, 0))) AS p FROM d)),
        again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth FROM w) WHERE nth > 1),
        marked AS (SELECT doc_id, p, p > coalesce(max(p + 100) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS new FROM again),
        spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b
                  FROM (SELECT doc_id, p, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM marked) GROUP BY doc_id, k),
        cuts AS (SELECT doc_id, coalesce(lag(b) OVER v, 0) AS x, a AS y FROM spans WINDOW v AS (PARTITION BY doc_id ORDER BY a)
                 UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
        kept AS (SELECT d.doc_id, string_agg(substr(h, CAST(2 * x + 1 AS BIGINT), CAST(coalesce(2 * (y - x), length(h)) AS BIGINT)), '' ORDER BY x) AS h
                 FROM cuts JOIN d ON d.doc_id = cuts.doc_id GROUP BY d.doc_id),
        n AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
        SELECT d.doc_id AS doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
    """,
    "op8_url_filter": f"""
        WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                          regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        r AS (SELECT *, CASE
            WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
            WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule FROM u)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r
    """,
    "op10_decontaminate": rf"""
        WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SQL_WORD}') AS w FROM documents),
        items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SQL_WORD}') AS w FROM benchmark),
        wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, k + 1, k + 10) AS win
                 FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS k FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM wins),
        runs AS (SELECT doc_id, n, k, list_slice(w, k + 1, k + n) AS win
                 FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS k FROM words, sizes WHERE len(w) >= n)),
        places AS (SELECT doc_id, k, wins.n AS n, item_id FROM runs JOIN wins ON runs.n = wins.n AND runs.win = wins.win),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM places)) GROUP BY doc_id),
        listed AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                          string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
                   FROM places GROUP BY doc_id)
        SELECT words.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words LEFT JOIN hit ON words.doc_id = hit.doc_id LEFT JOIN listed ON words.doc_id = listed.doc_id
    """,
    "op11_conversation_repair": r"""
        WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
        src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                       concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k FROM conversations),
        crc AS (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT))),
                    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS m FROM src, tab),
        dam AS (SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
                       CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                       unnest(CASE WHEN m = 3 THEN [0, 1] ELSE [0] END) AS copy FROM crc WHERE m <> 0),
        num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                       NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                       NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut, left(role, 1) AS r FROM dam),
        rowz AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                        lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS r0 FROM num),
        st(q, nx, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
        ins AS (SELECT q, '' AS e, 0 AS c, q AS z, CAST([] AS VARCHAR[]) AS l FROM st
                UNION ALL SELECT q, 'I', 3, nx, [role || ':'] FROM st
                UNION ALL SELECT a.q, 'II', 6, b.nx, [a.role || ':', b.role || ':'] FROM st a JOIN st b ON a.nx = b.q),
        moves AS (SELECT conv_id, i, ins.q, w.z, ins.e || w.e AS e, ins.c + w.c AS c, list_concat(ins.l, w.l) AS l
                  FROM ins JOIN (
            SELECT conv_id, i, q, 'D' AS e, 4 AS c, q AS z, CAST([] AS VARCHAR[]) AS l FROM rowz, st
            UNION ALL SELECT conv_id, i, q, 'K', CASE WHEN cut THEN 3 ELSE 0 END, CASE r WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, [rowz.role || ':' || text]
            FROM rowz, st WHERE NOT blank AND NOT again AND (r = 's' AND q = 0 OR r = 'u' AND q <> 2 OR r = 'a' AND q = 2)
            UNION ALL SELECT conv_id, i, q, 'R', CASE WHEN cut THEN 6 ELSE 3 END, nx, [st.role || ':' || text] FROM rowz, st WHERE NOT blank AND NOT again) w ON ins.z = w.q),
        best AS (SELECT conv_id, 0 AS i, 0 AS q, CAST(0 AS BIGINT) AS c, '' AS e, CAST([] AS VARCHAR[]) AS l FROM (SELECT DISTINCT conv_id FROM rowz)
                 UNION ALL
                 SELECT conv_id, i, z, c, e, l FROM (
                     SELECT b.conv_id, m.i, m.z, b.c + m.c AS c, b.e || m.e AS e, list_concat(b.l, m.l) AS l
                     FROM best b JOIN moves m ON b.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = b.i + 1 AND m.q = b.q)
                 QUALIFY row_number() OVER (PARTITION BY conv_id, z ORDER BY c, e) = 1),
        facts AS (SELECT conv_id, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
                         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
                         count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
                         count(*) FILTER (i > 1 AND NOT coalesce(r0 || r IN ('su', 'ua', 'au'), false)) AS illegal FROM rowz GROUP BY conv_id),
        done AS (SELECT b.conv_id, b.c + ins.c AS c, b.e || ins.e AS e, list_concat(b.l, ins.l) AS l
                 FROM best b JOIN facts f ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.i = f.n JOIN ins ON b.q = ins.q WHERE ins.z IN (0, 3)
                 QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.c + ins.c, b.e || ins.e) = 1)
        SELECT s.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(c, 0) AS cost, coalesce(e, '') AS audit, sha256(coalesce(array_to_string(l, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) s LEFT JOIN facts f ON s.conv_id IS NOT DISTINCT FROM f.conv_id
        LEFT JOIN done d ON s.conv_id IS NOT DISTINCT FROM d.conv_id
    """,
    "op12_lexical_search": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{ANY_WORD}'), lambda x: translate(x, '{UPPER}', '{LOWER}')) AS t FROM documents),
        q AS (SELECT row_number() OVER () AS q, item_id, list_transform(regexp_extract_all(coalesce(text, ''), '{ANY_WORD}'), lambda x: translate(x, '{UPPER}', '{LOWER}')) AS t FROM benchmark),
        s AS (SELECT count(*) FILTER (len(t) > 0) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d),
        tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * CAST(n AS DOUBLE) + 2) / (2 * CAST(count(*) AS DOUBLE) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, n),
        a AS (SELECT q, term, count(*) AS k FROM (SELECT q, unnest(t) AS term FROM q) GROUP BY ALL),
        m AS (SELECT r, doc_id, 100 - 25 + ((25 * len(t) * n) // l) AS m FROM d, s WHERE len(t) > 0),
        x AS (SELECT q, r, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
              FROM a JOIN w ON a.term = w.term JOIN tf ON tf.term = a.term JOIN m USING (r) GROUP BY q, r),
        y AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
              FROM x JOIN m USING (r) WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM y JOIN q USING (q) WHERE rank <= 20
    """,
}
