"""DuckDB SQL for the queries that SQL can express."""

ORACLE = {
    "op1_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), windows AS (
            SELECT doc_id, pos, array_to_string(words[pos : pos + 12], ' ') AS w
            FROM split, unnest(range(1, len(words) - 11)) AS p(pos)
        ), firsts AS (
            SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w
        ), gone AS (
            SELECT DISTINCT doc_id, pos + k AS pos
            FROM windows JOIN firsts USING (w), unnest(range(13)) AS p(k)
            WHERE first_id < doc_id
        ), tokens AS (
            SELECT doc_id, pos, words[pos] AS word
            FROM split, unnest(range(1, len(words) + 1)) AS p(pos)
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
            FROM tokens ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)
    """,
    "op2_mixing": """
        WITH RECURSIVE sized AS (
            SELECT source, sum(coalesce(length(text), 0) + 1) AS size
            FROM documents GROUP BY source
        ), rated AS (
            SELECT source,
                   sqrt(size) / sum(sqrt(size)) OVER () * sum(size) OVER () / size AS rate
            FROM sized
        ), parted AS (
            SELECT source, rate, greatest(ceil(rate / 16), 1)::INT AS parts,
                   rate / greatest(ceil(rate / 16), 1) AS mean
            FROM rated
        ), below AS (
            SELECT source, 0 AS k, exp(-mean) AS p, exp(-mean) AS whole, mean FROM parted
            UNION ALL
            SELECT source, k + 1, p * mean / (k + 1), whole + p * mean / (k + 1), mean
            FROM below WHERE k < 96
        ), listed AS (
            SELECT parted.source, parts, list(whole) AS terms
            FROM parted JOIN below ON parted.source IS NOT DISTINCT FROM below.source
            GROUP BY parted.source, parts
        ), drawn AS (
            SELECT doc_id, documents.source, text, part, terms,
                   (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || part), 1, 13))
                       ::BIGINT + 0.5) / 4503599627370496.0 AS u
            FROM documents
            JOIN listed ON documents.source IS NOT DISTINCT FROM listed.source,
            unnest(range(1, parts + 1)) AS p(part)
        ), counted AS (
            SELECT doc_id, source, text,
                   sum(len(list_filter(terms, lambda t: t <= u)))::BIGINT AS n
            FROM drawn GROUP BY doc_id, source, text
        )
        SELECT doc_id, source, unnest(range(1, n + 1))::INT AS copy, sha256(text) AS text_sha256
        FROM counted
    """,
    "op8_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               row_number() OVER (same ORDER BY doc_id DESC) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_jaccard_join": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(words[pos : pos + 2], ' ') AS s
            FROM split, unnest(range(1, greatest(len(words) - 1, least(len(words), 1) + 1))) AS p(pos)
        ), sizes AS (
            SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            WHERE 10 * y.size >= 9 * x.size AND 10 * x.size >= 9 * y.size
            GROUP BY a.doc_id, b.doc_id, x.size, y.size
            HAVING 100 * count(*) >= 90 * (x.size + y.size - count(*))
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM split
            UNION
            SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
        )
        SELECT doc_id, coalesce(size, 0) AS n_shingles,
               (SELECT min(b) FROM reached WHERE a = doc_id) AS component_id,
               (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
        FROM split LEFT JOIN sizes USING (doc_id)
    """,
    "op10_topk": """
        WITH coded AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(embedding) > 0 AND vec_id IS NOT NULL
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))
                       ::BIGINT AS score
            FROM coded q JOIN coded c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_lexical_search": r"""
        WITH terms AS (
            SELECT row, id, t.word, count(*) AS tf FROM (
                SELECT row, id, unnest(regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word
                FROM (SELECT row_number() OVER () AS row, doc_id AS id, text FROM documents)) t
            GROUP BY ALL
        ), lengths AS (
            SELECT row, sum(tf)::BIGINT AS n FROM terms GROUP BY row
        ), corpus AS (
            SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
        ), weights AS (
            SELECT word, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM terms, corpus GROUP BY word, docs
        ), asked AS (
            SELECT DISTINCT item, item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word
            FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)
        ), scored AS (
            SELECT item, item_id, row, id, sum(w * ((1000000000 * tf)
                // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total)))))::BIGINT AS score
            FROM asked JOIN terms USING (word) JOIN weights USING (word) JOIN lengths USING (row), corpus
            GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, id NULLS LAST)::INT AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, id AS doc_id, score FROM ranked WHERE rank <= 50
    """,
    "op12_conversation_repair": r"""
        WITH RECURSIVE checked AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, (
                -- CRC-32, one byte after another
                list_reduce([4294967295::BIGINT] || list_transform(
                    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                    lambda c: ascii(c)::BIGINT),
                    lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda x, i:
                        xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))
            ) AS crc
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                        ELSE text END AS text
            FROM (SELECT *, xor(crc, 4294967295) % 20 AS fault FROM checked),
                 unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copies(copy)
            WHERE fault <> 0
        ), placed AS (
            SELECT *, row_number() OVER same_conv AS i, left(role, 1) AS initial,
                   lag(left(role, 1)) OVER same_conv AS previous,
                   regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
            FROM damaged
            WINDOW same_conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), faults AS (
            SELECT *, CASE
                WHEN ending = '' THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM placed
        ), inserts(state, audit, reached, lines) AS (VALUES
            (0, '', 0, []::VARCHAR[]), (1, '', 1, []), (2, '', 2, []), (3, '', 3, []),
            (0, 'I', 2, ['user:']), (1, 'I', 2, ['user:']), (2, 'I', 3, ['assistant:']),
            (3, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']),
            (1, 'II', 3, ['user:', 'assistant:'])
        ), edits(state, initial, edit, reached, cost, role) AS (VALUES
            (0, 's', 'K', 1, 0, ''), (0, 'u', 'K', 2, 0, ''), (1, 'u', 'K', 2, 0, ''),
            (2, 'a', 'K', 3, 0, ''), (3, 'u', 'K', 2, 0, ''),
            (0, NULL, 'R', 2, 3, 'user'), (1, NULL, 'R', 2, 3, 'user'),
            (2, NULL, 'R', 3, 3, 'assistant'), (3, NULL, 'R', 2, 3, 'user'),
            (0, NULL, 'D', 0, 4, ''), (1, NULL, 'D', 1, 4, ''), (2, NULL, 'D', 2, 4, ''),
            (3, NULL, 'D', 3, 4, '')
        ), reached AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS state,
                   {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS best
            FROM (SELECT DISTINCT conv_id FROM damaged)
            UNION ALL
            SELECT r.conv_id, f.i, e.reached, min({
                'cost': r.best.cost + 3 * length(n.audit) + e.cost
                    + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END,
                'audit': r.best.audit || n.audit || e.edit,
                'lines': r.best.lines || n.lines || CASE e.edit WHEN 'D' THEN []
                    WHEN 'K' THEN [f.role || ':' || f.text] ELSE [e.role || ':' || f.text] END})
            FROM reached r
            JOIN faults f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1
            JOIN inserts n ON n.state = r.state
            JOIN edits e ON e.state = n.reached AND coalesce(e.initial = f.initial, true)
                AND (e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
            GROUP BY r.conv_id, f.i, e.reached
        ), ended AS (
            SELECT r.conv_id, min({'cost': r.best.cost + 3 * length(n.audit),
                'audit': r.best.audit || n.audit, 'lines': r.best.lines || n.lines}) AS best
            FROM reached r
            JOIN (SELECT conv_id, max(i) AS i FROM faults GROUP BY conv_id) l
                ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND l.i = r.i
            JOIN inserts n ON n.state = r.state AND n.reached IN (0, 3)
            GROUP BY r.conv_id
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv_id
        )
        SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
               coalesce(best.audit, '') AS audit,
               sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) ids
        LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
        LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM ids.conv_id
    """,
    "op13_secret_scan": r"""
        WITH rules(rule, listed, pattern, least, before) AS (VALUES
            ('assign', 0, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+', 8, true),
            ('access', 1, 'AKIA[A-Z0-9]{12,}', 16, false),
            ('hex', 2, '[0-9a-f]{32,}', 32, false),
            ('github', 3, 'gh[pousr]_[A-Za-z0-9]{36,}', 0, false),
            ('slack', 4, 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, false),
            ('private_key', 5, '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, false)
        ), found AS (
            SELECT doc_id, row, rule, listed, least, before,
                   regexp_extract_all(text, pattern) AS matches,
                   regexp_split_to_array(text, pattern) AS gaps
            FROM (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents), rules
        ), placed AS (
            SELECT doc_id, row, rule, listed, least, before, i, matches[i] AS m,
                   sum(length(gaps[i]) + length(matches[i])) OVER (PARTITION BY row, rule ORDER BY i)::INT AS e
            FROM found, unnest(range(1, len(matches) + 1)) AS t(i)
        ), held AS (
            SELECT row, rule, listed, e - length(m) AS s, e, listed < 3 AS base FROM placed
            WHERE length(CASE WHEN before THEN regexp_replace(m, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?', '') ELSE m END) >= least
        ), summed AS (
            SELECT row, count(*) FILTER (rule = 'assign') AS n_assign,
                   count(*) FILTER (rule = 'access') AS n_access, count(*) FILTER (rule = 'hex') AS n_hex,
                   string_agg(rule || ':' || s || ':' || e, ',' ORDER BY s, listed) FILTER (base) AS b,
                   string_agg(rule || ':' || s || ':' || e, ',' ORDER BY s, listed) AS spans
            FROM held GROUP BY row
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256,
               coalesce(spans, '') AS spans
        FROM (SELECT doc_id, row_number() OVER () AS row FROM documents) LEFT JOIN summed USING (row)
    """,
}
