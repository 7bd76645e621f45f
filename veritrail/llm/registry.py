"""The queries of this subpackage, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op7_byte_bpe
from .hnsw import op4_hnsw
from .language import op9_language
from .media import op5_gif_media
from .mixing import op6_mixing
from .negatives import op13_hard_negatives
from .packing import op11_packing
from .quality import op10_quality
from .simhash import op2_simhash
from .spelling import LOWER, UPPER, op12_spelling
from .tokens import op3_token_ids
from .toxicity import op8_toxicity
from .urls import op1_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_urls": op1_urls,
    "op2_simhash": op2_simhash,
    "op3_token_ids": op3_token_ids,
    "op4_hnsw": op4_hnsw,
    "op5_gif_media": op5_gif_media,
    "op6_mixing": op6_mixing,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_packing": op11_packing,
    "op12_spelling": op12_spelling,
    "op13_hard_negatives": op13_hard_negatives,
}

#: All pairs of a label and the closure of the links: for tables of some thousand vectors.
HNSW_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b), least AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(counts.n, 0) AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id"""

#: All rows for each anchor.
NEGATIVES_SQL = """WITH sound AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
rows_ AS (SELECT *, row_number() OVER () AS place FROM sound),
scored AS (SELECT a.vec_id AS anchor_id, a.place AS a_place, b.vec_id AS id, b.place AS place, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM rows_ a JOIN rows_ b ON len(a.q) = len(b.q) AND a.place <> b.place WHERE a.vec_id % 100 = 0),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a_place ORDER BY score DESC, id, place) <= 5)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.a_place, p.place ORDER BY n.score DESC, n.id, n.place) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.a_place = n.a_place AND NOT n.same AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a_place, p.place ORDER BY n.score DESC, n.id, n.place) <= 10"""



def crc32_sql(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes: each byte in two halves, by a table of 16 entries that is made from the polynomial."""

    def entry(c: int) -> int:
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        return c

    table = f"[{', '.join(str(entry(i)) for i in range(16))}]"
    half = f"xor({{0}} >> 4, {table}[({{0}} & 15) + 1])"
    step = half.format(half.format("xor(a, b)"))
    octets = f"list_transform(range(strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda a, b: {step}), 4294967295)"


#: Pairs of near words by equal deletions, and their forms followed one by one.
SPELLING_SQL = f"""WITH RECURSIVE runs AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY 1, 2),
hashed AS (SELECT run, k, {crc32_sql("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM runs), spelt AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY 1 HAVING sum(k) >= 5), less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, CAST(unnest(range(length(word))) AS INT) AS i FROM words)),
short AS (SELECT DISTINCT less.word AS a, words.word AS b FROM less JOIN words ON less.d = words.word), pairs AS (SELECT x.word AS a, y.word AS b FROM less x JOIN less y ON x.d = y.d AND x.i = y.i AND x.word <> y.word UNION SELECT a, b FROM short UNION SELECT b, a FROM short),
near AS (SELECT a, b, w.n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place FROM pairs JOIN words w ON w.word = b), known AS (SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near.n >= 5 * words.n THEN b END AS form, CASE WHEN near.n >= 5 * words.n THEN near.n END AS form_n FROM words LEFT JOIN near ON a = word AND place = 1),
chain AS (SELECT word, word AS root FROM known UNION SELECT chain.word, known.form FROM chain JOIN known ON known.word = chain.root WHERE known.form IS NOT NULL), last AS (SELECT chain.word, root FROM chain JOIN known ON known.word = root WHERE known.form IS NULL)
SELECT known.word, form, root, n, n_near, form_n FROM known JOIN last USING (word)"""

ORACLE: dict[str, str] = {"op12_spelling": SPELLING_SQL, "op4_hnsw": HNSW_SQL, "op13_hard_negatives": NEGATIVES_SQL}
