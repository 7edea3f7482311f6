"""The same results as DuckDB SQL, where SQL can state them."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SPACED = f"regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+')"

SQL: dict[str, str] = {
    "op4_warc": """
        WITH payload AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        marked AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS digest FROM payload),
        best AS (SELECT digest, max(page_id) AS response FROM marked WHERE n >= 1000 GROUP BY digest)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN response <> page_id THEN response END AS refers_to
        FROM marked LEFT JOIN best USING (digest)""",
    "op7_near_dedup": f"""
        WITH RECURSIVE
        cut AS (SELECT doc_id, {_SPACED} AS w FROM documents),
        shingled AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM cut),
        sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s FROM shingled),
        posted AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS shared
                   FROM posted a JOIN posted b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        pairs AS (SELECT x, y FROM common WHERE 100 * shared >= 75 * (nx + ny - shared)),
        links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
        reach(node, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT reach.node, links.y FROM reach JOIN links ON reach.other = links.x),
        comp AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
        SELECT sized.doc_id, n AS n_shingles, component_id, sized.doc_id = component_id AS kept
        FROM sized JOIN comp ON sized.doc_id = comp.node""",
    "op8_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
                   FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (SELECT q.vec_id AS query_id, o.vec_id,
                          CAST(list_inner_product(CAST(q.c AS DOUBLE[]), CAST(o.c AS DOUBLE[])) AS BIGINT) AS score
                   FROM v q JOIN v o ON q.vec_id % 20 = 0 AND o.vec_id <> q.vec_id),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op10_decontaminate": f"""
        WITH cut AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
        item AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
        windowed AS (
            SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
                ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS p
            FROM item),
        lengths AS (SELECT DISTINCT len(p) AS l FROM windowed),
        places AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS pos FROM cut, lengths WHERE len(w) >= l),
        found AS (SELECT doc_id, pos, l, item_id FROM places JOIN windowed ON p = w[pos:pos + l - 1]),
        hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM
                (SELECT doc_id, unnest(range(pos, pos + l)) AS k FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM cut LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    # The checksum is worked out bit by bit, lowest first, with the reversed polynomial.
    "op12_variants": """
        WITH RECURSIVE
        run AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
        counted AS (SELECT run, count(*) AS n, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS x
                    FROM run GROUP BY doc_id, run),
        summed AS (
            SELECT run, n, xor(4294967295, list_reduce([4294967295] || list_transform(range(4 * len(x)), lambda i:
                    ((strpos('0123456789ABCDEF', x[i // 8 * 2 + 2 - i % 8 // 4]) - 1) >> (i % 4)) & 1),
                lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS h
            FROM counted),
        damaged AS (SELECT CASE WHEN h % 97 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM summed),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged GROUP BY word HAVING sum(n) >= 3 AND len(word) >= 5),
        skips AS (SELECT word, n, i, word[:i] AS p, word[i + 2:] AS s FROM (SELECT word, n, unnest(range(len(word))) AS i FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n FROM skips a JOIN skips b ON a.i = b.i AND a.p = b.p AND a.s = b.s AND a.word <> b.word
            UNION SELECT skips.word, words.word, words.n FROM skips JOIN words ON words.word = p || s
            UNION SELECT words.word, skips.word, skips.n FROM skips JOIN words ON words.word = p || s),
        best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
        formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
                          CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
                   FROM words w LEFT JOIN best USING (word)),
        chain(word, top) AS (SELECT word, word FROM words
                             UNION SELECT chain.word, form FROM chain JOIN formed ON formed.word = top WHERE form IS NOT NULL)
        SELECT formed.word, formed.form, top AS root, formed.n, formed.n_near, formed.form_n
        FROM formed JOIN chain ON formed.word = chain.word JOIN formed t ON t.word = top AND t.form IS NULL""",
    "op13_collocations": f"""
        WITH numbered AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
                                 regexp_split_to_array({_LOWERED}, '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents),
        piece AS (SELECT d, lang, unnest(pieces) AS p, generate_subscripts(pieces, 1) AS pn FROM numbered),
        cut AS (SELECT d, lang, pn, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
        word AS (SELECT d, lang, pn, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM cut),
        run AS (SELECT lang, w, lead(w) OVER same AS x, lead(w, 2) OVER same AS y FROM word WINDOW same AS (PARTITION BY d, pn ORDER BY i)),
        f AS (SELECT lang, 1 AS k, w AS phrase, count(*) AS c FROM run GROUP BY ALL
              UNION ALL SELECT lang, 2, w || ' ' || x, count(*) FROM run WHERE x IS NOT NULL GROUP BY ALL
              UNION ALL SELECT lang, 3, w || ' ' || x || ' ' || y, count(*) FROM run WHERE y IS NOT NULL GROUP BY ALL),
        often AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 10),
        inner_pair AS (SELECT lang, phrase, max(a) AS longer FROM (
                SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, a FROM often, (SELECT unnest([1, 2]) AS i) WHERE k = 3) GROUP BY ALL),
        kept AS (SELECT often.* FROM often LEFT JOIN inner_pair USING (lang, phrase) WHERE k = 3 OR longer IS NULL OR 100 * longer < 50 * a),
        scored AS (
            SELECT kept.lang, kept.phrase, a, x.c AS l, y.c AS r, j,
                   CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.c AS HUGEINT) * y.c) AS BIGINT) AS score
            FROM kept, (SELECT unnest([1, 2]) AS j)
            JOIN f x ON x.lang = kept.lang AND x.phrase = array_to_string(w[1:j], ' ')
            JOIN f y ON y.lang = kept.lang AND y.phrase = array_to_string(w[j + 1:], ' ')
            WHERE j < kept.k),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        totals AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM lowest JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
