"""SQL for the queries that SQL can express."""

from __future__ import annotations

from tideline.llm import chat, hosts, merkle, resampling

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


OP5 = r"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT doc_id, pos, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed
    WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.last_doc AS gone
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, coalesce(sum(gone::INT), 0)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def shrunk(children: str, parents: str, key: str) -> str:
    """A level of hosts.shrunk as a query."""
    return f"""
    SELECT c.*, (c.k + coalesce(w.weight, {hosts.MOST_WEIGHT}) * p.mean) / (c.n + coalesce(w.weight, {hosts.MOST_WEIGHT})) AS mean,
        coalesce(w.weight, {hosts.MOST_WEIGHT}) AS weight
    FROM {children} c JOIN {parents} p ON c.{key} IS NOT DISTINCT FROM p.{key}
    LEFT JOIN (
        SELECT {key}, least(greatest(CASE WHEN likeness > 0 THEN 1 / likeness - 1 ELSE {hosts.MOST_WEIGHT} END, {hosts.LEAST_WEIGHT}), {hosts.MOST_WEIGHT}) AS weight
        FROM (
            SELECT c.{key}, (sum(n * pow(k / n - p.mean, 2)) - sum(p.mean * (1 - p.mean)))
                / nullif(greatest(sum(p.mean * (1 - p.mean) * (n - 1)), 0), 0) AS likeness
            FROM (SELECT * REPLACE (n::DOUBLE AS n, k::DOUBLE AS k) FROM {children}) c
            JOIN (SELECT {key}, mean FROM {parents}) p ON c.{key} IS NOT DISTINCT FROM p.{key} WHERE n > 0 GROUP BY c.{key}
        )
    ) w ON c.{key} IS NOT DISTINCT FROM w.{key}"""


def op9() -> str:
    two = ", ".join(f"'{s}'" for s in hosts.TWO_LABEL_SUFFIXES)
    fits = "".join(
        f"\n        WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'"
        for r in sorted(hosts.RULES, key=lambda r: -len(r.text))
    )
    says = "".join(f" WHEN '{r.text}' THEN '{r.verdict}'" for r in hosts.RULES)
    return rf"""
WITH p AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {AZ}) AS host,
        regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages)
), known AS (
    SELECT doc_id AS page_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), h0 AS (
    SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k, string_split(regexp_replace(regexp_replace(host, ':\d*$', ''), '\.$', ''), '.') AS l
    FROM p LEFT JOIN known USING (page_id) GROUP BY host
), h1 AS (
    SELECT host, n, k, l, array_to_string(l[-2:], '.') AS two, array_to_string(l[-2:], '.') IN ({two}) AS is_two FROM h0
), h AS (
    SELECT host, n, k, CASE WHEN is_two THEN two ELSE l[-1] END AS suffix,
        CASE WHEN is_two THEN array_to_string(l[-3:], '.') ELSE two END AS domain
    FROM h1
), d AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM h GROUP BY suffix, domain
), s AS (SELECT suffix, 1 AS whole, sum(n) AS n, sum(k) AS k FROM d GROUP BY suffix
), w AS (SELECT 1 AS whole, (sum(k) + 1.0) / (sum(n) + 1.0) AS mean FROM s
), s2 AS ({shrunk("s", "w", "whole")}
), d2 AS ({shrunk("d", "s2", "suffix")}
), h2 AS ({shrunk("h", "d2", "domain")}
), u AS (SELECT host, least(1.0, mean + {hosts.BOUND} * sqrt(mean * (1 - mean) / (n + weight + 1))) AS upper FROM h2
), r AS (SELECT page_id, host, path, CASE{fits} END AS rule FROM p
)
SELECT page_id, host, path, rule,
    CASE rule{says} ELSE CASE WHEN upper < {hosts.LEAST_GOOD} THEN 'block' ELSE 'allow' END END AS verdict
FROM r LEFT JOIN u USING (host)
"""


def op6() -> str:
    template = chat.INST
    text = f"replace(text, '{chat.ESCAPE}', '{chat.ESCAPE}z')"
    for control in template.controls:
        text = f"replace({text}, '{control}', '{chat.ESCAPE}{template.codes[control[0]]}{control[1:]}')"
    role = text.replace("replace(text", "replace(role")
    marks = "".join(f" WHEN '{r}' THEN {len(m.begin) + len(m.end)}" for r, m in template.roles.items())
    other = len(template.other + template.named + template.other_end)
    loss = ", ".join(f"'{r}'" for r, m in template.roles.items() if m.loss)
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'), (-7::BIGINT, 1::BIGINT, 'assistant', '</s>[INST] ok [/INST]')
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS all_text,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role IN ({loss})), '') AS loss_text,
        sum(length({text}) + CASE role{marks} ELSE {other} + length({role}) END)::BIGINT AS formatted_chars,
        string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE '?' END, '' ORDER BY turn NULLS FIRST, role, text) AS path
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(loss_text) AS loss_chars, sha256(loss_text) AS loss_sha256, formatted_chars,
    regexp_full_match(path, 's?u(au)*a?') AS valid
FROM whole
"""


def crc32(hex_bytes: str) -> str:
    """The unsigned crc32 of the bytes given as hexadecimal text; needs the one-row table crc_table(entries) joined."""
    byte = f"('0x' || substr({hex_bytes}, 2 * i + 1, 2))::BIGINT"
    listed = f"list_transform(range(length({hex_bytes}) // 2), lambda i: {byte})"
    step = "lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])"
    return f"xor(list_reduce({listed}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def crc_table() -> str:
    """entries: the remainder of each byte, eight shifts of the polynomial."""
    value = "n"
    for _ in range(8):
        value = f"(SELECT CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM (SELECT {value} AS v))"
    return f"crc_table AS (SELECT list(e ORDER BY n) AS entries FROM (SELECT n, {value} AS e FROM (SELECT unnest(range(256)) AS n)))"


def op11() -> str:
    low = f"translate(coalesce(text, ''), {AZ})"
    words = rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH {crc_table()}, doc_words AS (SELECT row_number() OVER () AS row_no, doc_id, {words} AS words FROM documents
), doc_word AS (SELECT row_no, unnest(words) AS word FROM doc_words
), target_word AS (SELECT unnest({words}) AS word FROM benchmark
), known AS (
    SELECT word, {crc32("hex(encode(word))")} % {resampling.BUCKETS} AS bucket
    FROM (SELECT word FROM doc_word UNION SELECT word FROM target_word), crc_table
), s AS (SELECT bucket, count(*) AS n FROM doc_word JOIN known USING (word) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS n FROM target_word JOIN known USING (word) GROUP BY bucket
), whole AS (
    SELECT (SELECT count(*) FROM doc_word)::DOUBLE AS s_all, (SELECT count(*) FROM target_word)::DOUBLE AS t_all
), gains AS (
    SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + {resampling.BUCKETS})
        / ((s.n + 1)::DOUBLE * (t_all + {resampling.BUCKETS}))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), whole
), sums AS (
    SELECT row_no, sum(gain)::BIGINT AS total FROM doc_word JOIN known USING (word) JOIN gains USING (bucket) GROUP BY row_no
), weighed AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / len(words)), 0)::BIGINT AS weight,
        ('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8))::BIGINT AS h
    FROM doc_words LEFT JOIN sums USING (row_no)
), scored AS (
    SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score,
        n_features >= {resampling.LEAST_WORDS} AND doc_id IS NOT NULL AS takes_part
    FROM weighed
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY takes_part ORDER BY score DESC, doc_id, n_features, weight) AS place,
        sum(takes_part::INT) OVER () AS n
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN takes_part AND place <= n * {resampling.PERCENT} // 100 THEN place END AS rank FROM placed
"""


def op12() -> str:
    def told(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"

    fields = [told(f) for f in merkle.FIELDS[:-1]]
    tampered = f"CASE WHEN {crc32('hex(encode(doc_id::VARCHAR))')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    fan = merkle.FAN

    def climb(name: str, leaves: str) -> str:
        """All nodes (tree, level, place, digest, n at that level)."""
        return f"""{name} AS (
    SELECT tree, 0 AS level, place, digest, n FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, place // {fan}, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + {fan - 1}) // {fan}
    FROM {name} WHERE n > 1 GROUP BY tree, level, place // {fan}
)"""

    def runs(name: str, nodes: str) -> str:
        return f"""{name} AS (
    SELECT tree, level, place // {fan} AS run, list(digest ORDER BY place) AS members FROM {nodes} WHERE n > 1 GROUP BY ALL
)"""

    before = f"array_to_string(members[:place % {fan}], '')"
    after = f"array_to_string(members[place % {fan} + 2:], '')"
    # a walk goes up its tree with the siblings met so far and the digest folded so far
    def walk(name: str, starts: str, runs_of: str) -> str:
        return f"""{name} AS (
    SELECT row_no, tree, 0 AS level, place, siblings, folded FROM {starts}
    UNION ALL
    SELECT row_no, w.tree, w.level + 1, place // {fan}, siblings || {before} || {after}, sha256({before} || folded || {after})
    FROM {name} w JOIN {runs_of} r ON w.tree = r.tree AND w.level = r.level AND w.place // {fan} = r.run
)"""

    def last(name: str) -> str:
        return f"(SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY level DESC) = 1)"

    return f"""
WITH RECURSIVE {crc_table()}, hashed AS (
    SELECT doc_id, source, sha256({" || ".join(fields)} || {told("text")}) AS digest,
        sha256({" || ".join(fields)} || {told(f"({tampered})")}) AS claimed
    FROM documents, crc_table
), leaves AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER () AS row_no,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS place, count(*) OVER (PARTITION BY source) AS n
    FROM hashed
), {climb("nodes", "leaves")}, {runs("node_runs", "nodes")}, subroots AS (
    SELECT -1 AS tree, tree AS place, digest, count(*) OVER () AS n FROM nodes WHERE n = 1
), {climb("tops", "subroots")}, {runs("top_runs", "tops")
}, starts AS (SELECT row_no, tree, place, '' AS siblings, claimed AS folded FROM leaves
), {walk("inner_walk", "starts", "node_runs")
}, outer_starts AS (SELECT row_no, -1 AS tree, tree AS place, siblings, folded FROM {last("inner_walk")}
), {walk("outer_walk", "outer_starts", "top_runs")}
SELECT doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
FROM leaves l JOIN {last("outer_walk")} USING (row_no) JOIN subroots s ON s.place = l.tree, (SELECT digest FROM tops WHERE n = 1) r
"""
