"""Comparison SQL of cleaning, copies and text queries."""

from checks.sql import cte, percent, rounded, statement, strings

ORACLES: dict[str, str] = {}


def add(name: str, deps: str, body: str) -> None:
    ORACLES[name] = statement(deps, body)


STOP_WORDS = (
    "the of and to in is that it for on with as are this be by from or an at not "
    "le la les de des et un une en du au que qui der die das und ist von zu den mit ein eine el los las y se lo por con"
).split()
WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
BODY = "trim(regexp_replace(coalesce(text, ''), '[ \\t\\r\\n\\f]+', ' ', 'g'))"
NORMAL = "trim(regexp_replace(lower(coalesce(text, '')), '[ \\t\\r\\n\\f]+', ' ', 'g'))"
RULES = {
    "empty": f"{BODY} = ''",
    "too_short": f"length({BODY}) < 2",
    "link": f"regexp_matches({BODY}, '(?i)(https?://|www\\.|[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}})')",
    # no back-references here: look for five times any of the characters that occur
    "repeated": "len(list_filter(list_distinct(string_split(coalesce(text, ''), '')), "
    "lambda c: c NOT IN (chr(10), chr(13), chr(133), chr(8232), chr(8233)) AND c <> '' AND contains(text, repeat(c, 5)))) > 0",
    "no_letters": f"NOT regexp_matches({BODY}, '\\p{{L}}')",
}
SPACED = ["casino", "viagra", "token", "password"]
JOINED = ["加微信", "刷单", "代刷", "兼职"]
TERM = f"(list_has_any({WORDS}, [{strings(SPACED)}])" + "".join(f" OR contains(text, '{t}')" for t in JOINED) + ")"

add("clean_blacklist", "", f"SELECT doc_id, source FROM documents WHERE NOT {TERM}")
add("clean_blacklist_table", "", f"SELECT doc_id, source FROM documents WHERE NOT {TERM}")
add(
    "clean_spam_regex",
    "",
    "SELECT doc_id, " + ", ".join(f"CAST({sql} AS BIGINT) AS {name}" for name, sql in RULES.items()) + " FROM documents",
)
add(
    "dedup_exact",
    "",
    f"SELECT md5({NORMAL}) AS digest, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1",
)


def simhash_ctes(prefix: str, source: str, deps: str = "") -> None:
    """Signatures, close pairs by comparing all of them, and reachability, over (doc_id, text)."""
    hashed = f"SELECT doc_id, CAST(concat('0x', substr(md5(w), 1, 15)) AS BIGINT) AS h FROM (SELECT doc_id, unnest({WORDS}) AS w FROM {source})"
    sums = ", ".join(f"sum((h >> {i}) & 1) AS b{i}" for i in range(60))
    bits = " + ".join(f"CASE WHEN 2 * b{i} > n THEN {1 << i} ELSE 0 END" for i in range(60))
    cte(
        f"{prefix}_signed",
        deps,
        f"SELECT doc_id, CAST({bits} AS BIGINT) AS signature FROM (SELECT doc_id, count(*) AS n, {sums} FROM ({hashed}) GROUP BY doc_id)",
    )
    cte(f"{prefix}_folded", f"{prefix}_signed", f"SELECT signature, min(doc_id) AS first_id FROM {prefix}_signed GROUP BY 1")
    cte(
        f"{prefix}_pairs",
        f"{prefix}_folded",
        f"""SELECT a.signature AS low, b.signature AS high, a.first_id AS a, b.first_id AS b,
       CAST(bit_count(xor(a.signature, b.signature)) AS BIGINT) AS distance
FROM {prefix}_folded a JOIN {prefix}_folded b ON a.signature < b.signature AND bit_count(xor(a.signature, b.signature)) <= 3""",
    )
    cte(
        f"{prefix}_reach",
        f"{prefix}_pairs",
        f"""/*recursive*/ SELECT first_id AS node, first_id AS seen FROM {prefix}_folded
UNION SELECT r.node, e.b FROM {prefix}_reach r
      JOIN (SELECT a, b FROM {prefix}_pairs UNION SELECT b, a FROM {prefix}_pairs) e ON e.a = r.seen""",
    )
    cte(
        f"{prefix}_groups",
        f"{prefix}_reach",
        f"""SELECT s.doc_id, r.keep_id FROM {prefix}_signed s JOIN {prefix}_folded f USING (signature)
JOIN (SELECT node, min(seen) AS keep_id FROM {prefix}_reach GROUP BY node) r ON r.node = f.first_id""",
    )


simhash_ctes("near", "documents")
add("dedup_simhash_pairs", "near_pairs", "SELECT low, high, distance FROM near_pairs")
add(
    "dedup_simhash",
    "near_groups",
    "SELECT doc_id, keep_id, CAST(doc_id = keep_id AS BIGINT) AS is_kept FROM near_groups",
)
_FIRST = "CASE " + " ".join(f"WHEN {sql} THEN '{name}'" for name, sql in RULES.items()) + f" WHEN {TERM} THEN 'blacklist' END"
cte("checked", "", f"SELECT doc_id, text, {_FIRST} AS failed FROM documents")
cte(
    "unique_valid",
    "checked",
    f"SELECT min(doc_id) AS doc_id, arg_min(text, doc_id) AS text, count(*) AS copies FROM checked WHERE failed IS NULL GROUP BY md5({NORMAL})",
)
simhash_ctes("valid", "unique_valid", "unique_valid")
add(
    "clean_report",
    "valid_groups",
    ", removed AS ("
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS step_no, '{n}' AS step, count(*) FILTER (WHERE failed = '{n}') AS removed FROM checked"
        for i, n in enumerate([*RULES, "blacklist"], 1)
    )
    + f""" UNION ALL SELECT 7, 'exact_copy', CAST(coalesce(sum(copies - 1), 0) AS BIGINT) FROM unique_valid
UNION ALL SELECT 8, 'near_copy', count(*) FILTER (WHERE doc_id <> keep_id) FROM valid_groups),
run AS (SELECT *, CAST(sum(removed) OVER (ORDER BY step_no) AS BIGINT) AS gone, (SELECT count(*) FROM documents) AS total FROM removed)
SELECT step_no, step, total - gone + removed AS rows_in, removed, total - gone AS rows_out,
       {percent('total - gone', 'total', 2)} AS retention_pct FROM run""",
)

# Words
cte(
    "doc_words",
    "",
    f"""SELECT doc_id, source, w AS word FROM (SELECT doc_id, source, unnest({WORDS}) AS w FROM documents)
WHERE w NOT IN ({strings(STOP_WORDS)})""",
)
add("tx_tokenize", "doc_words", "SELECT doc_id, word, count(*) AS tf FROM doc_words GROUP BY 1, 2")
# The lexicon of the joined phrases: strings of up to six characters, framed by two marks
cte(
    "phrase_runs",
    "",
    """SELECT replace(trim(regexp_replace(p, '\\s+', ' ', 'g')), ' ', '') AS run
FROM (SELECT unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}\\s]+')) AS p FROM documents)""",
)
cte(
    "run_strings",
    "phrase_runs",
    """SELECT substr(framed, i, k) AS string, k AS length, sum(times) AS n
FROM (SELECT chr(2) || run || chr(3) AS framed, count(*) AS times FROM phrase_runs WHERE run <> '' GROUP BY run) f,
     range(1, 7) l(k), LATERAL (SELECT unnest(range(1, length(framed) - k + 2)) AS i) GROUP BY 1, 2""",
)
cte(
    "inner_strings",
    "run_strings",
    "SELECT * FROM run_strings WHERE NOT contains(string, chr(2)) AND NOT contains(string, chr(3))",
)
_SPREAD = "round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6)"
add(
    "tx_word_lexicon",
    "inner_strings",
    f""", candidate AS (SELECT * FROM inner_strings WHERE length BETWEEN 2 AND 5 AND n >= 5),
cohesion AS (
  SELECT c.string, round(min(ln(CAST(c.n AS DOUBLE) / a.n) - ln(CAST(b.n AS DOUBLE) / (SELECT sum(n) FROM inner_strings WHERE length = 1))), 6) AS cohesion
  FROM (SELECT string, n, unnest(range(1, length)) AS k FROM candidate) c
  JOIN inner_strings a ON a.string = substr(c.string, 1, k) JOIN inner_strings b ON b.string = substr(c.string, k + 1) GROUP BY c.string),
after AS (SELECT substr(string, 1, length - 1) AS string, {_SPREAD} AS entropy FROM run_strings WHERE length > 2 GROUP BY 1),
before AS (SELECT substr(string, 2) AS string, {_SPREAD} AS entropy FROM run_strings WHERE length > 2 GROUP BY 1)
SELECT string AS word, CAST(n AS BIGINT) AS n, cohesion, freedom
FROM (SELECT c.string, c.n, cohesion, least(a.entropy, b.entropy) AS freedom FROM candidate c
      JOIN cohesion USING (string) JOIN after a USING (string) JOIN before b USING (string))
WHERE cohesion >= 1.5 AND freedom >= 1.0
UNION ALL SELECT string, CAST(n AS BIGINT), NULL, NULL FROM inner_strings WHERE length = 1""",
)
cte(
    "song_keywords",
    "doc_words",
    """SELECT source, word, tf, document_count, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, word) AS keyword_rank
FROM (SELECT g.source, g.word, g.tf, d.document_count,
             round(g.tf / sum(g.tf) OVER (PARTITION BY g.source)
                   * (ln(((SELECT count(*) FROM documents) + 1) / (d.document_count + 1)) + 1), 6) AS score
      FROM (SELECT source, word, count(*) AS tf FROM doc_words GROUP BY 1, 2) g
      JOIN (SELECT word, count(DISTINCT doc_id) AS document_count FROM doc_words GROUP BY 1) d USING (word))
QUALIFY keyword_rank <= 20""",
)
add("tx_tfidf_song", "song_keywords", "SELECT * FROM song_keywords")
add("gd_song_keywords12", "song_keywords", "SELECT source, word, score, keyword_rank FROM song_keywords WHERE keyword_rank <= 12")
cte(
    "global_keywords",
    "doc_words",
    """SELECT word, tf, document_count, score, row_number() OVER (ORDER BY score DESC, word) AS keyword_rank
FROM (SELECT word, count(*) AS tf, count(DISTINCT doc_id) AS document_count,
             round(count(*) / sum(count(*)) OVER () * (ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT doc_id) + 1)) + 1), 6) AS score
      FROM doc_words GROUP BY word) QUALIFY keyword_rank <= 20""",
)
add("tx_tfidf_global", "global_keywords", "SELECT * FROM global_keywords")
add("gd_global_keywords20", "global_keywords", "SELECT word, score FROM global_keywords")
cte(
    "lexicon",
    "doc_words doc_sentiment",
    """SELECT word, round(ln((p + 1) / (sum(p) OVER () + count(*) OVER ())) - ln((n + 1) / (sum(n) OVER () + count(*) OVER ())), 6) AS weight
FROM (SELECT word, count(*) FILTER (WHERE sentiment = 'positive') AS p, count(*) FILTER (WHERE sentiment = 'negative') AS n
      FROM doc_words JOIN doc_sentiment USING (doc_id) WHERE sentiment <> 'neutral' GROUP BY word)""",
)
add(
    "tx_sentiment_lexicon",
    "lexicon doc_words",
    f""", sums AS (SELECT doc_id, count(*) AS matched,
      {rounded('sum(CAST(round(weight * 1000000) AS BIGINT))', 'count(*) * 1000000', 6)} AS score
      FROM doc_words JOIN lexicon USING (word) GROUP BY doc_id)
SELECT d.doc_id, coalesce(matched, 0) AS matched, score,
       CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment
FROM documents d LEFT JOIN sums USING (doc_id)""",
)
