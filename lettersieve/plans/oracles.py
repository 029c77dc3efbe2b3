"""DuckDB SQL that gives the same results as the registered queries, for checking."""

from __future__ import annotations

WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def _clean(column: str) -> str:
    for code in (28, 29, 30, 31):
        column = f"replace({column}, chr({code}), '0x{code:X}')"
    return column


def _words(column: str) -> str:
    return WORDS.format(_clean(column))


# Named queries; each statement below is put behind those it needs.
VIEWS = {
    "messages": """
        SELECT md5(source) AS box,
               CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS uid,
               doc_id,
               concat(source, '@example.org') AS h_from,
               concat(lang, '-list@example.org') AS h_to,
               split_part(text, chr(10), 1) AS subject,
               text AS body
        FROM documents""",
    "message_fields": """
        SELECT box, uid, 'from' AS field, h_from AS value FROM messages
        UNION ALL SELECT box, uid, 'to', h_to FROM messages
        UNION ALL SELECT box, uid, 'subject', subject FROM messages
        UNION ALL SELECT box, uid, 'body', body FROM messages""",
    "build_events": """
        SELECT md5(CAST(conv_id % 10 AS VARCHAR)) AS box, conv_id + 1 AS uid, turn AS seq,
               CASE role WHEN 'user' THEN 'BODY_PART' WHEN 'assistant' THEN 'MIME_HDR' ELSE 'HDR' END AS key_type,
               CASE role WHEN 'user' THEN NULL WHEN 'assistant' THEN 'X-Reply.Part' ELSE 'Subject' END AS hdr_name,
               text AS value
        FROM conversations""",
    "ops": """
        SELECT md5(CAST(user_id % 20 AS VARCHAR)) AS box, user_id + 1 AS uid, event_id AS seq, ts,
               CASE WHEN event_type = 'error' THEN 'delete' ELSE 'index' END AS op,
               event_type AS subject, props AS body
        FROM events""",
    "checkpoints": """
        SELECT box, CAST(max(uid) // 2 AS BIGINT) AS last_indexed_uid
        FROM messages
        WHERE h_from LIKE '%0@%' OR h_from LIKE '%2@%' OR h_from LIKE '%4@%'
        GROUP BY box""",
    "expunges": """
        SELECT box, uid FROM messages WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "header_values": """
        SELECT box, uid, seq, hdr_name, translate(lower(hdr_name), '.#*"', '____') AS field, value
        FROM build_events WHERE key_type IN ('HDR', 'MIME_HDR') AND hdr_name <> ''""",
    "first_bodies": """
        SELECT box, uid, seq, value FROM build_events WHERE key_type = 'BODY_PART'
        QUALIFY row_number() OVER (PARTITION BY box, uid ORDER BY seq) = 1""",
    "all_bodies": "SELECT box, uid, seq, value FROM build_events WHERE key_type = 'BODY_PART'",
    "last_ops": """
        SELECT * FROM ops QUALIFY row_number() OVER (PARTITION BY box, uid ORDER BY seq DESC) = 1""",
    "applied": "SELECT box, uid, seq, subject, body FROM last_ops WHERE op = 'index'",
    "backlog": """
        SELECT m.box, m.uid FROM messages m LEFT JOIN checkpoints c ON m.box = c.box
        WHERE m.uid > coalesce(c.last_indexed_uid, 0)""",
    "field_words": f"SELECT box, uid, field, {_words('value')} AS words FROM message_fields",
    "lens": "SELECT box, uid, field, CAST(len(words) AS BIGINT) AS field_len FROM field_words",
    "all_words": "SELECT box, uid, field, unnest(words) AS term FROM field_words",
    "postings": """
        SELECT t.box, t.field, t.term, t.uid, CAST(count(*) AS BIGINT) AS tf, any_value(l.field_len) AS field_len
        FROM all_words t JOIN lens l ON t.box = l.box AND t.uid = l.uid AND t.field = l.field
        GROUP BY t.box, t.field, t.term, t.uid""",
    "stats": """
        SELECT box, field, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(field_len) AS BIGINT) AS total_len,
               max(uid) AS max_uid
        FROM lens WHERE field_len > 0 GROUP BY box, field""",
    "dfs": "SELECT box, field, term, CAST(count(*) AS BIGINT) AS df FROM postings GROUP BY box, field, term",
    "weighted": """
        SELECT p.box, p.field, p.term, p.uid,
               ln(1.0::DOUBLE + (s.n_docs - d.df + 0.5::DOUBLE) / (d.df + 0.5::DOUBLE)) * p.tf * 2.2::DOUBLE
               / (p.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * p.field_len / (s.total_len / s.n_docs))) AS w
        FROM postings p
        JOIN dfs d ON p.box = d.box AND p.field = d.field AND p.term = d.term
        JOIN stats s ON p.box = s.box AND p.field = s.field""",
}

NEEDS = {
    "message_fields": ["messages"],
    "checkpoints": ["messages"],
    "expunges": ["messages"],
    "header_values": ["build_events"],
    "first_bodies": ["build_events"],
    "all_bodies": ["build_events"],
    "last_ops": ["ops"],
    "applied": ["last_ops"],
    "backlog": ["messages", "checkpoints"],
    "field_words": ["message_fields"],
    "lens": ["field_words"],
    "all_words": ["field_words"],
    "postings": ["all_words", "lens"],
    "stats": ["lens"],
    "dfs": ["postings"],
    "weighted": ["postings", "dfs", "stats"],
}


def _with(needs: list[str], select: str, extra: dict[str, str] | None = None) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    parts = {name: VIEWS[name] for name in ordered} | (extra or {})
    heads = ",\n".join(f"{name} AS ({body})" for name, body in parts.items())
    return f"WITH {heads}\n{select}"


def _scored(value: str, fields: str, operator: str) -> str:
    """(box, uid, field, score) of one search value; ``fields`` as in an IN list."""
    every = f"HAVING count(*) = (SELECT count(DISTINCT q) FROM (SELECT unnest({_words(_text(value))}) AS q))"
    return f"""
        SELECT box, uid, field, sum(w) AS score FROM weighted
        WHERE field IN ({fields}) AND term IN (SELECT unnest({_words(_text(value))}))
        GROUP BY box, uid, field {every if operator == "and" else ""}"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _hits(value: str, fields: str, operator: str = "or") -> str:
    scored = _scored(value, fields, operator)
    return f"SELECT box, uid, round(max(score), 6) AS score FROM ({scored}) GROUP BY box, uid"


DEFAULTS = "'from', 'to', 'subject', 'body'"
RANGES = """
    SELECT box, min(uid) AS uid_lo, max(uid) AS uid_hi
    FROM (SELECT box, uid, uid - row_number() OVER (PARTITION BY box ORDER BY uid) AS island
          FROM (SELECT DISTINCT box, uid FROM hits))
    GROUP BY box, island"""


def _ranked(group: str = "box") -> str:
    return f"""
            SELECT *, CAST(row_number() OVER (PARTITION BY {group} ORDER BY score DESC, uid) AS BIGINT) AS rank
            FROM hits"""


def _top(limit: str, group: str = "box") -> str:
    return f"""
        SELECT * FROM ({_ranked(group)})
        WHERE rank <= {limit}"""


def _batch(fields: str, operator: str) -> dict[str, str]:
    """Hits of the query batch: each benchmark text is a search value."""
    every = "HAVING count(*) = any_value(n_terms)" if operator == "and" else ""
    return {
        "query_words": f"""
            SELECT item_id AS query_id, list_distinct({_words("text")}) AS terms FROM benchmark""",
        "query_terms": "SELECT query_id, len(terms) AS n_terms, unnest(terms) AS term FROM query_words",
        "hits": f"""
            SELECT query_id, box, uid, round(max(score), 6) AS score
            FROM (SELECT q.query_id, w.box, w.uid, w.field, sum(w.w) AS score
                  FROM weighted w JOIN query_terms q ON w.term = q.term
                  WHERE w.field IN ({fields})
                  GROUP BY q.query_id, w.box, w.uid, w.field {every})
            GROUP BY query_id, box, uid""",
    }


# As many hits of a box as its next uid says, or 10,000 if that is less.
CAP = "least(10000, (SELECT max(uid) + 1 FROM messages m WHERE m.box = hits_ranked.box))"

ARGUMENTS = """
    SELECT item_id AS query_id, 1 AS arg_no,
           ['header', 'header_address', 'header_compress_lwsp'][CAST(item_id % 3 + 1 AS BIGINT)] AS kind,
           'SUBJECT' AS header, 'subject' AS field
    FROM benchmark
    UNION ALL SELECT item_id, 2, 'body', NULL, 'body' FROM benchmark WHERE item_id % 2 = 0
    UNION ALL SELECT item_id, 2, 'text', NULL, unnest(['from', 'to', 'subject', 'body'])
              FROM benchmark WHERE item_id % 2 = 1
    UNION ALL SELECT item_id, 3, 'flags', NULL, NULL FROM benchmark WHERE item_id % 2 = 0
    UNION ALL SELECT item_id, 3, 'header', 'X.Secret', NULL FROM benchmark WHERE item_id % 2 = 1"""


def _long_form(bodies: str) -> str:
    return f"""
        SELECT box, uid, field,
               CAST(row_number() OVER (PARTITION BY box, uid, field ORDER BY seq) AS BIGINT) AS pos,
               {_clean("value")} AS value
        FROM (SELECT box, uid, field, seq, value FROM header_values
              UNION ALL SELECT box, uid, 'body', seq, value FROM {bodies})"""


ACTION_FIELDS = """SELECT box, uid, 'subject' AS field, subject AS value FROM applied
                    UNION ALL SELECT box, uid, 'body', body FROM applied"""
CONTROL_BYTES = " || ".join(f"chr({code})" for code in (28, 29, 30, 31))
ACTION = "json_object(op, json_object('_index', box, '_type', 'mail', '_id', uid))"
MESSAGE_BYTES = "strlen(h_from) + strlen(h_to) + strlen(subject) + strlen(body)"
RESPONSES = """
    SELECT '{"took":1,"hits":{"hits":[' || string_agg(
             '{"_score":' || CAST(strlen(body) / 8.0::DOUBLE AS VARCHAR) || ',"_source":{"uid":'
             || CASE WHEN uid % 2 = 1 THEN '[' || uid || ']' ELSE CAST(uid AS VARCHAR) END
             || CASE uid % 7 WHEN 0 THEN '' WHEN 1 THEN ',"box":[]' WHEN 2 THEN ',"box":[null]'
                             WHEN 3 THEN ',"box":"' || box || '"' ELSE ',"box":["' || box || '"]' END || '}}', ',')
           || ']}}' AS value
    FROM messages GROUP BY box, uid // 10"""
FIRST_OR_SELF = """CASE json_type(hit, '$._source.{0}') WHEN 'ARRAY' THEN json_extract_string(hit, '$._source.{0}[0]')
                   ELSE json_extract_string(hit, '$._source.{0}') END"""


def _matches(condition: str) -> str:
    return f"""
        SELECT box, uid, CAST(count(*) AS BIGINT) AS n_matches FROM postings
        WHERE field IN ('subject', 'body') AND {condition} GROUP BY box, uid"""


def statements(c) -> dict[str, str]:
    """SQL by query name. ``c`` is the catalog module, whose search values are used."""
    exact = c.EXACT_VALUE
    allowed = "'subject'"
    body_and = _hits(c.VALUE, "'body'", "and")
    two_sided = {"one": body_and, "two": _hits(c.SECOND_VALUE, "'subject'")}
    found = {
        "assemble_documents": _with(["header_values", "first_bodies"], _long_form("first_bodies")),
        "assemble_documents_all_parts": _with(["header_values", "all_bodies"], _long_form("all_bodies")),
        "body_first_part": _with(["first_bodies"], "SELECT box, uid, value AS body FROM first_bodies"),
        "normalize_fields": _with(
            ["header_values"],
            "SELECT hdr_name, field, CAST(count(*) AS BIGINT) AS n_values FROM header_values GROUP BY hdr_name, field",
        ),
        "sanitize_values": _with(
            ["message_fields"],
            f"""SELECT field, CAST(count(value) AS BIGINT) AS n_values,
                       CAST(sum(CASE WHEN cleaned <> value THEN 1 ELSE 0 END) AS BIGINT) AS n_changed,
                       CAST(sum(strlen(cleaned)) AS BIGINT) AS n_bytes_after
                FROM (SELECT field, value, {_clean("value")} AS cleaned FROM marked) GROUP BY field""",
            {"marked": f"SELECT field, translate(value, '{c.MARKED}', {CONTROL_BYTES}) AS value FROM message_fields"},
        ),
        "field_catalog": _with(
            ["header_values", "first_bodies"],
            """SELECT field, CAST(count(DISTINCT (box, uid)) AS BIGINT) AS n_docs,
                      CAST(count(*) AS BIGINT) AS n_occurrences,
                      CAST(count(DISTINCT hdr_name) AS BIGINT) AS n_raw_names
               FROM (SELECT box, uid, field, hdr_name FROM header_values
                     UNION ALL SELECT box, uid, 'body', NULL FROM first_bodies) GROUP BY field""",
        ),
        "bulk_export": _with(
            ["ops"],
            f"""SELECT box, uid, seq,
                       CASE WHEN op = 'delete' THEN CAST({ACTION} AS VARCHAR)
                            ELSE concat(CAST({ACTION} AS VARCHAR), chr(10),
                                 CAST(json_object('uid', uid, 'box', box, 'subject', {_clean("subject")},
                                                  'body', {_clean("body")}) AS VARCHAR)) END AS lines
                FROM ops""",
        ),
        "bulk_batches": _with(
            ["messages"],
            f"""SELECT box, uid, CAST((upto - bytes) // {c.BATCH_LIMIT} AS BIGINT) AS batch
                FROM (SELECT box, uid, {MESSAGE_BYTES} AS bytes,
                             sum({MESSAGE_BYTES}) OVER (PARTITION BY box ORDER BY uid) AS upto FROM messages)""",
        ),
        "decode_hits": _with(
            ["messages"],
            f"""SELECT box, uid, score
                FROM (SELECT {FIRST_OR_SELF.format("box")} AS box,
                             TRY_CAST({FIRST_OR_SELF.format("uid")} AS BIGINT) AS uid,
                             TRY_CAST(json_extract_string(hit, '$._score') AS DOUBLE) AS score
                      FROM (SELECT unnest(json_extract(value, '$.hits.hits[*]')) AS hit FROM responses))
                WHERE box IS NOT NULL AND uid IS NOT NULL AND score IS NOT NULL""",
            {"responses": RESPONSES},
        ),
        "content_audit": _with(
            ["applied"],
            """SELECT coalesce(a.box, i.box) AS box, coalesce(a.uid, i.uid) AS uid,
                      CASE WHEN i.uid IS NULL THEN 'missing' WHEN a.uid IS NULL THEN 'stray' ELSE 'changed' END AS kind
               FROM applied a FULL JOIN indexed i ON a.box = i.box AND a.uid = i.uid
               WHERE a.uid IS NULL OR i.uid IS NULL
                  OR a.subject IS DISTINCT FROM i.subject OR a.body IS DISTINCT FROM i.body""",
            {
                "indexed": f"""
        SELECT box, uid, subject, body
        FROM (SELECT * FROM ops WHERE subject <> {_text(c.MISSED)}
              QUALIFY row_number() OVER (PARTITION BY box, uid ORDER BY seq DESC) = 1)
        WHERE op = 'index'"""
            },
        ),
        "apply_ops": _with(["applied"], "SELECT * FROM applied"),
        "apply_ops_stream": _with(["applied"], "SELECT * FROM applied"),
        "expunge": _with(["expunges"], "SELECT box, uid FROM messages EXCEPT SELECT box, uid FROM expunges"),
        "last_uid": _with(
            ["checkpoints"],
            """SELECT m.box, CAST(coalesce(any_value(c.last_indexed_uid), max(m.uid), 0) AS BIGINT) AS last_uid
               FROM messages m LEFT JOIN checkpoints c ON m.box = c.box GROUP BY m.box""",
        ),
        "index_backlog": _with(["backlog"], "SELECT * FROM backlog"),
        "advance_checkpoints": _with(
            ["backlog"],
            """SELECT coalesce(c.box, b.box) AS box,
                      CAST(greatest(coalesce(last_indexed_uid, reached), coalesce(reached, last_indexed_uid)) AS BIGINT)
                      AS last_indexed_uid
               FROM checkpoints c
               FULL JOIN (SELECT box, max(uid) AS reached FROM backlog GROUP BY box) b ON c.box = b.box""",
        ),
        "rescan": _with(["messages"], "SELECT box, uid FROM messages"),
        "index_gaps": _with(
            ["expunges", "applied"],
            """SELECT box, uid, 'missing_from_index' AS kind FROM expunges
               UNION ALL
               SELECT box, uid, 'missing_from_source' FROM applied
               WHERE (box, uid) NOT IN (SELECT (box, uid) FROM messages)
               EXCEPT SELECT box, uid, 'missing_from_index' FROM applied""",
        ),
        "update_postings": _with(
            ["postings", "expunges", "applied"],
            """SELECT box, field, term, uid, tf, field_len FROM postings
               WHERE (box, uid) NOT IN (SELECT (box, uid) FROM expunges UNION ALL SELECT (box, uid) FROM applied)
               UNION ALL
               SELECT box, field, term, uid, CAST(count(*) AS BIGINT), CAST(any_value(len(words)) AS BIGINT)
               FROM (SELECT box, field, uid, words, unnest(words) AS term FROM new_words)
               GROUP BY box, field, term, uid""",
            {
                "new_words": f"""
                    SELECT box, uid, 'subject' AS field, {_words("subject")} AS words FROM applied
                    UNION ALL SELECT box, uid, 'body', {_words("body")} FROM applied"""
            },
        ),
        "build_postings": _with(["postings"], "SELECT * FROM postings"),
        "term_dictionary": _with(["dfs"], "SELECT * FROM dfs"),
        "field_stats": _with(["stats"], "SELECT * FROM stats"),
        "search_after_runs": _with(["weighted"], _hits(c.VALUE, "'body'")),
        "search_text": _with(["weighted"], _hits(c.VALUE, DEFAULTS)),
        "search_body": _with(["weighted"], _hits(c.VALUE, "'body'")),
        "search_header": _with(["weighted"], _hits(c.VALUE, "'subject'")),
        "search_multi_field": _with(["weighted"], _hits(c.MULTI_VALUE, "'from', 'subject', 'body'")),
        "search_operator": _with(
            ["weighted"],
            f"""SELECT box, uid, score, 'and' AS operator FROM ({_hits(c.VALUE, DEFAULTS, "and")})
                UNION ALL SELECT box, uid, score, 'or' FROM ({_hits(c.VALUE, DEFAULTS)})""",
        ),
        "search_not": _with(
            ["weighted"],
            "SELECT box, uid FROM messages EXCEPT SELECT box, uid FROM hits",
            {"hits": body_and},
        ),
        "search_combine_args": _with(
            ["weighted"],
            """SELECT one.box, one.uid, round(one.score + two.score, 6) AS score, 'and' AS operator
               FROM one JOIN two ON one.box = two.box AND one.uid = two.uid
               UNION ALL
               SELECT coalesce(one.box, two.box), coalesce(one.uid, two.uid),
                      round(coalesce(one.score, 0) + coalesce(two.score, 0), 6), 'or'
               FROM one FULL JOIN two ON one.box = two.box AND one.uid = two.uid""",
            two_sided,
        ),
        "search_header_allowlist": _with(["weighted"], _hits(c.ALLOWLIST_VALUE, allowed)),
        "residual_split": _with(
            ["weighted"],
            f"""SELECT m.box, m.uid FROM messages m JOIN hits h ON m.box = h.box AND m.uid = h.uid
                WHERE contains(lower(m.h_to), lower({_text(c.RESIDUAL_VALUE)}))""",
            {"hits": body_and},
        ),
        "residual_scan": _with(
            ["messages"],
            f"SELECT box, uid FROM messages WHERE contains(lower(h_to), lower({_text(c.RESIDUAL_VALUE)}))",
        ),
        "verify_maybe": _with(
            ["weighted"],
            f"""SELECT h.box, h.uid, h.score, 'maybe' AS certainty
                FROM messages m JOIN hits h ON m.box = h.box AND m.uid = h.uid
                WHERE contains(lower(m.body), lower({_text(exact)}))""",
            {"hits": _hits(exact, "'body'", "and")},
        ),
        "search_wildcard": _with(["postings"], _matches("term LIKE '%erti%'")),
        "search_fuzzy": _with(["postings"], _matches("levenshtein(term, 'ertion') <= 1")),
        "search_wildcard_grams": _with(["postings"], _matches("term LIKE '%erti%'")),
        # The SQL engine's distance counts bytes. No character beyond ASCII is in the asked word, so each may stand as '#'.
        "search_fuzzy_spellings": _with(
            ["postings"], _matches(r"levenshtein(regexp_replace(term, '[^\x00-\x7F]', '#', 'g'), 'ertion') <= 2")
        ),
        "range_algebra": _with(
            ["postings"],
            f"""SELECT operation, box, min(uid) AS uid_lo, max(uid) AS uid_hi
                FROM (SELECT operation, box, uid, uid - row_number() OVER (PARTITION BY operation, box ORDER BY uid) AS island
                      FROM (SELECT 'union' AS operation, * FROM (SELECT * FROM l UNION SELECT * FROM r)
                            UNION ALL SELECT 'intersection', * FROM (SELECT * FROM l INTERSECT SELECT * FROM r)
                            UNION ALL SELECT 'difference', * FROM (SELECT * FROM l EXCEPT SELECT * FROM r)))
                GROUP BY operation, box, island""",
            {
                name: f"SELECT DISTINCT box, uid FROM postings WHERE field = 'body' AND term LIKE '{pattern.replace('*', '%')}'"
                for name, pattern in zip("lr", c.RANGE_PATTERNS)
            },
        ),
        "score_hits": _with(
            ["weighted"],
            f"SELECT box, uid, field, round(score, 6) AS score FROM ({_scored(c.VALUE, DEFAULTS, 'or')})",
        ),
        "search_topk": _with(["weighted"], _top(str(c.TOP)), {"hits": _hits(c.VALUE, "'body'")}),
        "search_capped": _with(
            ["weighted"],
            _top(CAP).replace("FROM hits)", "FROM hits) AS hits_ranked"),
            {"hits": _hits(c.VALUE, DEFAULTS)},
        ),
        "hits_by_box": _with(
            ["weighted"],
            """SELECT t.*, r.n_ranges
               FROM (SELECT box, CAST(count(*) AS BIGINT) AS n_hits, min(uid) AS min_uid, max(uid) AS max_uid,
                            max(score) AS max_score FROM hits GROUP BY box) t
               JOIN (SELECT box, CAST(count(*) AS BIGINT) AS n_ranges FROM ranges GROUP BY box) r ON t.box = r.box""",
            {"hits": _hits(c.VALUE, "'body'"), "ranges": RANGES},
        ),
        "uid_ranges": _with(["messages"], RANGES, {"hits": "SELECT box, uid FROM messages WHERE contains(lower(body), 'ertion')"}),
        "search_multi_box": _with(["weighted"], _ranked(), {"hits": _hits(c.VALUE, DEFAULTS, "and")}),
        "search_batch": _with(["weighted"], _top(CAP, "query_id, box").replace("FROM hits)", "FROM hits) AS hits_ranked"), _batch(DEFAULTS, "or")),
        "search_batch_top": _with(["weighted"], _top(str(c.TOP), "query_id, box"), _batch(DEFAULTS, "or")),
        "search_batch_body_and": _with(["weighted"], _ranked("query_id, box"), _batch("'body'", "and")),
    }
    found |= {
        "assemble_chunks": found["assemble_documents"],
        "bulk_export_batches": _with(
            ["header_values", "first_bodies"],
            f"""SELECT box, uid, CAST((upto - bytes) // {c.EXPORT_LIMIT} AS BIGINT) AS batch,
                       CAST(json_object('index', json_object('_index', box, '_type', 'mail', '_id', uid)) AS VARCHAR) || chr(10)
                       || '{{"uid":' || uid || ',"box":"' || box || '",' || entries || '}}' AS lines
                FROM (SELECT box, uid, entries, bytes, sum(bytes) OVER (PARTITION BY box ORDER BY uid) AS upto
                      FROM (SELECT box, uid, sum(bytes) AS bytes,
                                   string_agg(CAST(to_json(field) AS VARCHAR) || ':' || CAST(to_json(vals) AS VARCHAR), ','
                                              ORDER BY field) AS entries
                            FROM (SELECT box, uid, field, list(value ORDER BY pos) AS vals, sum(strlen(value)) AS bytes
                                  FROM long GROUP BY box, uid, field) GROUP BY box, uid))""",
            {"long": _long_form("first_bodies")},
        ),
        "stored_checkpoints": _with(
            ["messages"],
            "SELECT box, CAST(max(uid) AS BIGINT) AS last_indexed_uid FROM messages GROUP BY box",
        ),
        "search_after_rescan": _with(
            ["weighted"],
            f"""SELECT box, uid, score, 'and' AS operator FROM ({_hits(c.VALUE, "'body'", "and")})
                UNION ALL SELECT box, uid, score, 'or' FROM ({_hits(c.VALUE, "'body'")})""",
        ),
        "search_after_updates": _with(
            ["messages", "expunges", "applied", "weighted"],
            _hits(c.UPDATED_VALUE, "'subject', 'body'"),
            {
                "message_fields": f"""
                    SELECT * FROM ({VIEWS["message_fields"]})
                    WHERE (box, uid) NOT IN (SELECT (box, uid) FROM expunges UNION ALL SELECT (box, uid) FROM applied)
                    UNION ALL {ACTION_FIELDS}"""
            },
        ),
        "search_after_stream": _with(
            ["applied", "weighted"], _hits(c.STREAM_VALUE, "'subject', 'body'"), {"message_fields": ACTION_FIELDS}
        ),
        "search_assembled": _with(
            ["header_values", "first_bodies", "weighted"],
            _hits(c.VALUE, "'subject', 'x-reply_part', 'body'"),
            {
                "field_words": f"""
                    SELECT box, uid, field, flatten(list(words ORDER BY pos)) AS words
                    FROM (SELECT box, uid, field, pos, {_words("value")} AS words FROM ({_long_form("first_bodies")}))
                    GROUP BY box, uid, field"""
            },
        ),
        "search_header_kinds": _with(["weighted"], _hits(c.MULTI_VALUE, "'from', 'subject'")),
        "search_not_nested": _with(
            ["weighted"],
            "SELECT box, uid FROM messages EXCEPT SELECT box, uid FROM hits",
            {"hits": _hits(c.VALUE, "'subject', 'body'", "and")},
        ),
        "residual_or": _with(
            ["weighted"],
            f"""SELECT box, uid FROM messages
                WHERE (box, uid) IN (SELECT (box, uid) FROM hits)
                   OR (NOT contains(lower(h_to), lower({_text(c.RESIDUAL_VALUE)})) AND contains(lower(h_from), 'src1'))""",
            {"hits": body_and},
        ),
    }
    found["search_after_many_runs"] = found["search_after_updates"]
    found["expunged_words"] = _with(
        ["postings", "expunges"],
        """SELECT box, field, term, CAST(count(*) AS BIGINT) AS df FROM postings
           WHERE (box, uid) IN (SELECT (box, uid) FROM expunges) GROUP BY box, field, term""",
    )
    found["split_arguments"] = _with(
        [],
        """SELECT query_id, arg_no, kind, coalesce(header, '') AS header, coalesce(field, '') AS field,
                  field IS NOT NULL AS is_indexed FROM arguments""",
        {"arguments": ARGUMENTS},
    )
    by_argument = _batch("SELECT field FROM arguments a WHERE a.query_id = q.query_id AND field IS NOT NULL", "and")
    found["search_batch_arguments"] = _with(
        ["weighted"], _ranked("query_id, box"), {"arguments": ARGUMENTS, **by_argument}
    )
    found["assemble_stream"] = found["assemble_chunks"]
    found["decode_hits_nested"] = found["decode_hits"]
    found["bulk_export_text"] = (
        f"SELECT unnest(string_split(lines, chr(10))) AS line FROM ({found['bulk_export_batches']})"
    )
    return found
