"""DuckDB SQL for those queries of this subpackage that SQL can express.

The others are tested against brute-force versions: packing needs a tokenizer,
SimHash and the seeded choices of mixing a hash that DuckDB lacks, sharding random
draws, the sketches peeling, the licence scan word statistics per line, the aligner
two tokenizers, and the classifier is trained.
"""

from __future__ import annotations

from .links import DAMPING, LINK, ROUNDS, RULES, THRESHOLD, UNIT

ORACLES: dict[str, str] = {}

ORACLES["op1_warc_chunks"] = """
    WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest
               FROM pages),
         f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS least FROM d)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 100 AND page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND page_id > least THEN least END AS refers_to
    FROM f"""

ORACLES["op2_bm25_topk"] = r"""
    WITH texts AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    words AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS term FROM texts),
    tf AS (SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL),
    len AS (SELECT doc_id, sum(n) AS n FROM tf GROUP BY doc_id),
    total AS (SELECT (SELECT count(*) FROM documents) AS docs,
                     (SELECT sum(n) FROM len) / (SELECT count(*) FROM documents) AS average),
    idf AS (SELECT term, ln(1 + (max(docs) - count(*) + 0.5) / (count(*) + 0.5)) AS w
            FROM tf, total GROUP BY term),
    scored AS (
        SELECT q.doc_id AS query_id, d.doc_id AS doc_id,
               round(sum(w * d.n * 2.2 / (d.n + 1.2 * (0.25 + 0.75 * len.n / average))), 6) AS score
        FROM tf q JOIN idf USING (term) JOIN tf d USING (term)
        JOIN len ON len.doc_id = d.doc_id, total
        WHERE q.doc_id % 100 = 0
        GROUP BY q.doc_id, d.doc_id),
    ranked AS (
        SELECT query_id, doc_id, score,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)
                    AS INTEGER) AS rank
        FROM scored WHERE score > 0)
    SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

ORACLES["op6_chat_perspectives"] = r"""
    WITH own AS (
        SELECT conv_id, coalesce(turn // 64, -1) AS part, turn,
               CASE WHEN coalesce(regexp_replace(trim(role), '[\x00-\x20<>|]+', '_', 'g'), '') = ''
                    THEN 'unknown'
                    ELSE regexp_replace(trim(role), '[\x00-\x20<>|]+', '_', 'g') END AS speaker,
               replace(coalesce(text, ''), '<|', '< |') AS body
        FROM conversations),
    cut AS (
        SELECT *, (row_number() OVER (
                   PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, speaker, body) - 1) // 64
                   AS section
        FROM own),
    sides AS (SELECT DISTINCT conv_id, speaker AS participant FROM own WHERE speaker <> 'system'),
    told AS (
        SELECT o.*, participant,
               '<|im_start|>' || CASE WHEN speaker = participant THEN 'assistant'
                                      WHEN speaker = 'system' THEN speaker
                                      ELSE 'user name=' || speaker END || chr(10) AS head
        FROM cut o JOIN sides s ON o.conv_id IS NOT DISTINCT FROM s.conv_id),
    placed AS (
        SELECT *, length(head) + length(body) + 11 AS width,
               coalesce(sum(length(head) + length(body) + 11) OVER (
                   PARTITION BY conv_id, part, section, participant
                   ORDER BY turn NULLS FIRST, speaker, body
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS first
        FROM told)
    SELECT conv_id, participant, CAST(part AS BIGINT) AS part,
           CAST(section AS BIGINT) AS section, CAST(count(*) AS INTEGER) AS turns,
           string_agg(head || body || '<|im_end|>' || chr(10), ''
                      ORDER BY turn NULLS FIRST, speaker, body) AS text,
           coalesce(string_agg(first || ':' || (first + length(body) + 10), ',' ORDER BY first)
                    FILTER (speaker = participant), '') AS mask,
           CAST(coalesce(sum(length(body) + 10) FILTER (speaker = participant), 0) AS BIGINT)
               AS trained
    FROM placed GROUP BY conv_id, part, section, participant"""

# CRC-32 by its table of 256 remainders, which the rule of the polynomial gives; letters
# of runs and digits take one or two bytes of UTF-8.
ORACLES["op11_spelling_variants"] = r"""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(256), lambda i: list_reduce(range(8),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
    runs AS (
        SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents),
    lowered AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w,
               count(*) AS n
        FROM runs WHERE length(run) >= 6 GROUP BY ALL),
    keyed AS (
        SELECT w, n, flatten(list_transform(string_split(doc_id || ':' || w, ''),
                   lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)]
                                  ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END)) AS b
        FROM lowered),
    hashed AS (
        SELECT w, n, xor(4294967295::BIGINT, list_reduce(b,
                   lambda h, x: xor(h >> 8, t[(xor(h, x::BIGINT) & 255) + 1]), 4294967295::BIGINT)) AS h
        FROM keyed, crc),
    faulty AS (
        SELECT CASE WHEN h % 199 = 0
                    THEN substring(w, 1, (h % length(w))::INT) || substring(w, (h % length(w))::INT + 2)
                    ELSE w END AS word, n
        FROM hashed),
    words AS (
        SELECT word, sum(n)::BIGINT AS n FROM faulty
        WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words),
    without AS (
        SELECT word, n, substring(word, 1, i - 1) || '*' || substring(word, i + 1) AS masked,
               substring(word, 1, i - 1) || substring(word, i + 1) AS shorter
        FROM places),
    pairs AS (
        SELECT a.word, a.n, b.word AS near, b.n AS near_n
        FROM without a JOIN without b USING (masked) WHERE a.word <> b.word
        UNION SELECT a.word, a.n, b.word, b.n FROM without a JOIN words b ON a.shorter = b.word
        UNION SELECT b.word, b.n, a.word, a.n FROM without a JOIN words b ON a.shorter = b.word),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place,
               count(*) OVER (PARTITION BY word) AS n_near
        FROM pairs),
    formed AS (
        SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
               CASE WHEN near_n >= 5 * w.n THEN near END AS form,
               CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
        FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
    chain AS (
        SELECT word, word AS root FROM formed
        UNION ALL
        SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
    SELECT word, form, last.root, n, n_near, form_n
    FROM formed JOIN (
        SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL) last
        USING (word)"""


def _rounds(edges: str, start: str, name: str) -> str:
    """The rounds of :func:`links.propagate` as one table expression each."""
    steps = [f"{name}0 AS MATERIALIZED (SELECT host, start AS rank FROM {start})"]
    for i in range(1, ROUNDS + 1):
        steps.append(
            f"""{name}{i} AS MATERIALIZED (
        SELECT host, sum(rank)::BIGINT AS rank FROM (
            SELECT dst AS host, (rank * {DAMPING} // 100) // degree AS rank
            FROM {edges} JOIN {name}{i - 1} ON src = host
            UNION ALL SELECT host, start - start * {DAMPING} // 100 FROM {start})
        GROUP BY host HAVING sum(rank) > 0)"""
        )
    return ",\n    ".join(steps)


def _rule(column: str) -> str:
    ordered = sorted(RULES, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r), reverse=True)
    cases = (
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
        f"THEN '{host + path if column == 'rule' else verdict}'"
        for host, path, verdict in ordered
    )
    return f"CASE {' '.join(cases)} END"


ORACLES["op13_url_filter"] = rf"""
    WITH rests AS (
        SELECT page_id, coalesce(html, '') AS html,
               CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    parts AS (
        SELECT page_id, html, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
               translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz') AS host
        FROM rests),
    judged AS MATERIALIZED (SELECT *, {_rule("rule")} AS rule, {_rule("verdict")} AS said FROM parts),
    found AS (SELECT host AS src, unnest(regexp_extract_all(html, '{LINK}', 1)) AS link FROM parts),
    lowered AS (
        SELECT DISTINCT src, translate(link, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                       'abcdefghijklmnopqrstuvwxyz') AS dst FROM found),
    edges AS MATERIALIZED (
        SELECT src, dst, count(*) OVER (PARTITION BY src) AS degree FROM lowered WHERE src <> dst),
    back AS MATERIALIZED (
        SELECT dst AS src, src AS dst, count(*) OVER (PARTITION BY dst) AS degree
        FROM lowered WHERE src <> dst),
    seeds AS (
        SELECT host, count(*) FILTER (said = 'allow') AS allowed, count(*) FILTER (said = 'block') AS blocked
        FROM judged GROUP BY host),
    trusted AS MATERIALIZED (
        SELECT host, (allowed::HUGEINT * {UNIT} // sum(allowed) OVER ())::BIGINT AS start
        FROM seeds WHERE allowed > 0),
    distrusted AS MATERIALIZED (
        SELECT host, (blocked::HUGEINT * {UNIT} // sum(blocked) OVER ())::BIGINT AS start
        FROM seeds WHERE blocked > 0),
    {_rounds("edges", "trusted", "t")},
    {_rounds("back", "distrusted", "d")},
    trust AS (SELECT host, (rank::HUGEINT * {UNIT} // sum(rank) OVER ())::BIGINT AS rank FROM t{ROUNDS}),
    distrust AS (SELECT host, (rank::HUGEINT * {UNIT} // sum(rank) OVER ())::BIGINT AS rank FROM d{ROUNDS})
    SELECT page_id, host, path, rule,
           coalesce(said, CASE WHEN coalesce(d.rank, 0) * 1000
                                    > (coalesce(t.rank, 0) + coalesce(d.rank, 0)) * {THRESHOLD}
                               THEN 'block' ELSE 'allow' END) AS verdict,
           coalesce(t.rank, 0) AS trust, coalesce(d.rank, 0) AS distrust
    FROM judged LEFT JOIN trust t USING (host) LEFT JOIN distrust d USING (host)"""
