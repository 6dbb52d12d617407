"""One query for each operator, over whole tables, with the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldshelf.llm import bpe, caps, chat, licenses, minhash, ngram_lm, packing, quality, repair, rules, tokenfile, toxicity, whitening

VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY, WORD_END = "word_bpe_49k.json", 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document; no given label is used."""
    return quality.scored(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of the corpus's own mixture."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and template labels of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and plain score of every document, learned from those that are not held out."""
    return ngram_lm.scored(table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similarity 0.85 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(percent=85))


def op6_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding at a cosine of 0.93 or more."""
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


#: The signs that are escaped, and a conversation that says the template's own control strings.
ROLE_SIGNS, TEXT_SIGNS = "\\#<:", "\\#<"
TRAP = "\\### Assistant: </turn> ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of turns and trainable texts, as read back from the formatted conversations."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], turns.schema)
    found = chat.read_back(chat.formatted(turns.unionByName(trap)))
    line = F.lit("\n")
    whole = F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line))
    trained = F.array_join(F.coalesce("replies", F.array().cast("array<string>")), "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(whole, ""), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all texts and what they decode to, as digests."""
    ids = bpe.encode(table(spark, sf_dir, "documents"), vocabulary_path())
    decoded = bpe.decode(ids, vocabulary_path())
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, compression ratios and verdict of every document."""
    return rules.judged(table(spark, sf_dir, "documents"))


def op11_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as read back from token files: places and digests of their ids."""
    files = tokenfile.write(table(spark, sf_dir, "documents"), vocabulary_path(WORD_VOCABULARY), WORD_END)
    return tokenfile.read(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding along the four leading components."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    return repair.repaired(repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_licenses": op3_licenses,
    "op4_ngram_lm": op4_ngram_lm,
    "op5_minhash": op5_minhash,
    "op6_caps": op6_caps,
    "op7_chat": op7_chat,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_rules": op10_rules,
    "op11_tokenfile": op11_tokenfile,
    "op12_whitening": op12_whitening,
    "op13_repair": op13_repair,
}

def _license_sql() -> str:
    """Every block against every template, word by word, without an index or a filter."""
    step = licenses.BLOCK // 2
    capitals, gaps = licenses._CAPITALS, licenses._GAPS
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    templates = ", ".join(
        f"({i}, '{label}', {quoted(sorted(set(licenses.template_words(text))))}, {quoted(needs)}::VARCHAR[])"
        for i, (label, text, needs) in enumerate(licenses.TEMPLATES)
    )
    places, base = [], []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split(" ")
        same = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(parts))
        places.append(f"list_filter(range(0, len(words) - {len(parts) - 1}), lambda i: {same})")
        base.append(f"CASE WHEN len({places[-1]}) > 0 THEN '{label}' END")
    return f"""
    WITH lines AS (
      SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), '{gaps}', ' ', 'g')) AS line
      FROM documents
    ), w AS (
      SELECT row_number() OVER () AS r, doc_id, CASE WHEN line = '' THEN [] ELSE string_split(line, ' ') END AS words FROM lines
    ), t(template, label, tw, needs) AS (VALUES {templates}
    ), s AS (
      SELECT r, unnest(list_transform(range(0, greatest(1, CAST(ceil((len(words) - {step}) / {step}.0) AS BIGINT))),
        lambda k: words[k * {step} + 1 : k * {step} + {licenses.BLOCK}])) AS run
      FROM w
    ), b AS (
      SELECT r, list_distinct(run) AS bw, ' ' || array_to_string(run, ' ') || ' ' AS line FROM s
    ), m AS (
      SELECT r, label, len(list_intersect(bw, tw)) / len(tw) AS containment
      FROM b, t WHERE len(list_intersect(bw, tw)) >= {licenses.THRESHOLD} * len(tw)
        AND len(list_filter(needs, lambda p: NOT contains(line, ' ' || p || ' '))) = 0
    ), f AS (SELECT r, list(DISTINCT label) AS found, max(containment) AS containment FROM m GROUP BY r
    ), p AS (
      SELECT r, doc_id, len(words) AS n_words, list_concat({places[0]}, list_concat({places[1]}, {places[2]})) AS places,
        list_filter([{", ".join(base)}], lambda x: x IS NOT NULL) AS base
      FROM w
    )
    SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
      array_to_string(list_sort(base), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
      CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0)::DOUBLE END AS score
    FROM p LEFT JOIN f USING (r)
    """


def _chat_sql() -> str:
    """Digests from the turns themselves; an escaped sign is one character longer."""
    trap = TRAP.replace("'", "''")

    def kept(column: str, signs: str) -> str:
        return f"2 * length({column}) - length(translate({column}, '{signs}', ''))"

    frame = len(chat.HEAD + chat.MIDDLE + chat.TAIL)
    return f"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{trap}' UNION ALL SELECT -7, 1, 'assistant', '{trap}'
    ), c AS (
      SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS trained,
        CAST(sum({frame} + {kept("role", ROLE_SIGNS)} + {kept("text", TEXT_SIGNS)}) AS BIGINT) AS formatted_chars
      FROM t GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(trained) AS loss_chars, sha256(trained) AS loss_sha256,
      formatted_chars FROM c
    """


def _repair_sql() -> str:
    """Row by row, the cheapest repair that ends in each of the four states, as cost, audit and lines."""
    far = "{'c': 1000000000, 'a': '', 't': ''}"
    white = r"\x20\x09-\x0D"

    def edit(state: str, cost: str, initial: str, line: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{initial}', 't': {state}.t || {line}}}"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def kept(state: str, letter: str) -> str:
        name = repair.NAMES.get(letter)
        found = [f"CASE WHEN able AND initial = '{letter}' THEN {edit(state, 'more', 'K', 'line')} ELSE {far} END"]
        if name:
            rerole = edit(state, f"more + {repair.COSTS[repair.REROLE]}", "R", f"chr(10) || '{name}:' || text")
            found.append(f"CASE WHEN able THEN {rerole} ELSE {far} END")
        return ", ".join(found)

    def inserted(state: str, letter: str) -> str:
        return edit(state, str(repair.COSTS[repair.INSERT]), "I", f"chr(10) || '{repair.NAMES[letter]}:'")

    def deleted(state: str) -> str:
        return edit(state, str(repair.COSTS[repair.DELETE]), "D")

    user = ", ".join(inserted(f"n{q}", "u") for q in (0, 1, 3))
    closed = f"""
      SELECT conv_id, i, n0 AS s0, n1 AS s1, m2 AS s2, {least("n3", inserted("m2", "a"))} AS s3
      FROM (SELECT *, {least("n2", user)} AS m2 FROM
    """
    return f"""
    WITH RECURSIVE crc AS (
      SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab
    ), g AS (
      SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
          lambda c: CAST(ascii(c) AS BIGINT)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS k
      FROM conversations, crc
    ), d AS (
      SELECT r, conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
        CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '{repair.ENDS}', '') ELSE text END AS text,
        unnest(CASE k WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM g
    ), o AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, r, copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, r, copy) AS again
      FROM d
    ), f AS (
      SELECT conv_id, i, turn, text, left(role, 1) AS initial, chr(10) || role || ':' || text AS line, fault,
        fault NOT IN ('b', 'd') AS able, CASE WHEN fault = 't' THEN {repair.TRUNCATED_COST} ELSE 0 END AS more,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
      FROM (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{white}]') THEN 'b' WHEN again > 1 THEN 'd'
        WHEN NOT regexp_matches(text, '[{repair.ENDS}][{white}]*$') THEN 't' ELSE '.' END AS fault FROM o)
    ), c AS (
      SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM f GROUP BY conv_id
    ), p AS (
      {closed} (SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': ''}} AS n0, {far} AS n1, {far} AS n2, {far} AS n3
        FROM (SELECT DISTINCT conv_id FROM conversations)))
      UNION ALL
      {closed} (SELECT f.conv_id, f.i, {deleted("s0")} AS n0, {least(deleted("s1"), kept("s0", "s"))} AS n1,
          {least(deleted("s2"), *(kept(f"s{q}", "u") for q in (0, 1, 3)))} AS n2, {least(deleted("s3"), kept("s2", "a"))} AS n3
        FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1))
    )
    SELECT p.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(least(s0, s3).c AS BIGINT) AS cost,
      least(s0, s3).a AS audit, sha256(substr(least(s0, s3).t, 2)) AS repaired_sha256
    FROM p LEFT JOIN c ON p.conv_id IS NOT DISTINCT FROM c.conv_id
    WHERE p.i = coalesce(c.n, 0)
    """


#: DuckDB's SQL for the queries that it can express.
ORACLE: dict[str, str] = {
    "op3_licenses": _license_sql(),
    "op7_chat": _chat_sql(),
    "op13_repair": _repair_sql(),
}
