"""DuckDB SQL of the queries that SQL can express on whole tables. The others
are tested against brute-force versions (tests/llm)."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY body)""",
    "op4_near_dedup": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]
                                             WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id,
               d.doc_id <= coalesce(min(r.b), d.doc_id) AS kept
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id""",
    "op6_license_scan": r"""
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        w AS (SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM t),
        phrase(words, label) AS (VALUES (['mit', 'license'], 'mit'), (['apache', 'license'], 'apache'), (['general', 'public', 'license'], 'gpl')),
        place AS (
          SELECT doc_id, label, unnest([i - 1 FOR i IN range(1, len(w.words) - len(p.words) + 2) IF w.words[i:i + len(p.words) - 1] = p.words]) AS start
          FROM w JOIN phrase p ON list_has_all(w.words, p.words)),
        base AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM place GROUP BY doc_id),
        template(label, notice) AS (VALUES
          ('mit', 'released under the mit license'),
          ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
          ('apache', 'licensed under the apache license version 2 0'),
          ('gpl', 'this work is licensed under the gnu general public license version 3'),
          ('gpl', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license'),
          ('cc-by-nc', 'licensed under cc by nc 4 0'),
          ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted'),
          ('mpl', 'this source code form is subject to the terms of the mozilla public license')),
        wanted AS (SELECT label, list_distinct(string_split(notice, ' ')) AS words FROM template),
        line AS (SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(text, chr(10))), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS words FROM t),
        held AS (
          SELECT doc_id, label, len(list_intersect(x.words, l.words)) / len(x.words) AS share
          FROM line l JOIN wanted x ON 10 * len(list_intersect(x.words, l.words)) >= 9 * len(x.words)),
        best AS (SELECT doc_id, max(share) AS share FROM held GROUP BY doc_id),
        labels AS (SELECT doc_id, label, true AS base FROM place UNION ALL SELECT doc_id, label, false FROM held),
        joined AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
                          string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM labels GROUP BY doc_id)
        SELECT w.doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
               coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
        FROM w LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN joined USING (doc_id)""",
    "op8_line_dedup": r"""
        WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM cut),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM l),
        rep AS (SELECT line_key, max(doc_id) AS keep_id FROM k WHERE length(line_key) >= 20
                GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
        f AS (SELECT k.*, rep.line_key IS NOT NULL AND k.doc_id <> rep.keep_id AS gone FROM k LEFT JOIN rep USING (line_key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM f GROUP BY doc_id""",
    "op9_substring_dedup": r"""
        WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        l AS (SELECT doc_id, h, length(h) // 2 AS n FROM t),
        w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM l WHERE n >= 200)),
        rep AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
        hit AS (SELECT doc_id, i FROM w JOIN rep USING (m)),
        cut AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM hit),
        runs AS (SELECT doc_id, min(i) AS s, max(i) + 200 AS e FROM (
                   SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM cut) GROUP BY doc_id, run),
        gaps AS (SELECT doc_id, coalesce(lag(e) OVER o, 0) AS a, s AS b FROM runs WINDOW o AS (PARTITION BY doc_id ORDER BY s)
                 UNION ALL SELECT doc_id, max(e), NULL FROM runs GROUP BY doc_id),
        kept AS (SELECT g.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS h FROM gaps g JOIN l USING (doc_id) GROUP BY g.doc_id),
        total AS (SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed FROM runs GROUP BY doc_id)
        SELECT l.doc_id, l.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept.h, l.h))) AS kept_sha256
        FROM l LEFT JOIN total USING (doc_id) LEFT JOIN kept ON kept.doc_id = l.doc_id""",
    "op12_source_divergence": r"""
        WITH t AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
        w AS (SELECT d, lang, source, unnest(words) AS term FROM t),
        kept AS (SELECT lang, term, count(*) AS all_c FROM w GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
        v AS (SELECT lang, count(*) AS v, sum(all_c) AS all_n FROM kept GROUP BY lang),
        c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
        g AS (SELECT DISTINCT lang, source FROM t),
        n AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
        p AS (SELECT n.lang, n.source, kept.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (n.n + 5 * v.v) AS p,
                     1 + (1000000000::HUGEINT * (kept.all_c + 5)) // (v.all_n + 5 * v.v) AS q
              FROM n JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
        pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
                 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
                 LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY a.lang, a.source, b.source),
        term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
                   FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 50""",
    "op13_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
                   FROM documents),
        f AS (SELECT part, doc_id, CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
                     || CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x) THEN 'C' ELSE '' END
                     || CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END
                     || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 'E' ELSE '' END AS fails FROM t),
        l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        m AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
        x(a) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
        o AS (SELECT p.a || q.a || r.a || s.a || z.a AS filter_order FROM x p, x q, x r, x s, x z
              WHERE len(list_distinct([p.a, q.a, r.a, s.a, z.a])) = 5),
        step AS (SELECT filter_order, i AS step, substr(filter_order, i, 1) AS own, substr(filter_order, 1, i - 1) AS earlier
                 FROM (SELECT filter_order, unnest(range(1, 6)) AS i FROM o)),
        r AS (SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS failed, translate(fails, earlier, '') <> fails AS gone FROM m, step),
        s AS (SELECT part, filter_order, step, own, sum(n) FILTER (WHERE NOT failed AND NOT gone) AS kept, sum(n) FILTER (WHERE failed AND NOT gone) AS removed,
                     sum(n) FILTER (WHERE failed AND gone) AS redundant, sum(n) FILTER (WHERE fails = own) AS unique_fails,
                     sum(good) FILTER (WHERE failed AND NOT gone) AS good_lost, sum(toxic) FILTER (WHERE failed AND NOT gone) AS toxic_lost
              FROM r GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley FROM s""",
}
