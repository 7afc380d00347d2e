"""Queries over whole tables for each operator, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotmill import constants as C
from plotmill.functions.text import TITLE_CASE, TOKEN, WS, draw_bits, lines, replace_all, strip, token_count, tokens
from plotmill.operators import chunking, context, dataset, fewshot, generation, grid, names, phrases, records, rows, screenplay, tags
from plotmill.session import table
from plotmill.sources import files

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SEED, CHUNK_TOKENS = 42, 300
TEMPLATE = ">Story: {story}\n>Context: {context}\n>Language: English"


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- pieces of SQL ---------------------------------------------------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:  # noqa: ANN001
    return "[" + ", ".join(map(_text, values)) + "]"


def _in(values) -> str:  # noqa: ANN001
    return "(" + ", ".join(map(_text, values)) + ")"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _tok(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, '{TOKEN}')), 0)"


def _lines(x: str) -> str:
    return rf"string_split_regex(regexp_replace({x}, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')"


def _bits(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


def _draw(*parts: str) -> str:
    return f"({_bits(*parts)} / 4294967296.0)"


def _kept(key: str) -> str:
    """A key of a record after quotes are straightened and tags dropped."""
    value = f"translate(prompt['{key}'], '“”', '\"\"')" if key in C.QUOTED_FIELDS else f"prompt['{key}']"
    if key not in C.DROPPABLE_TAGS:
        return value
    return f"(CASE WHEN {_draw(str(SEED).join(chr(39) * 2), 'record_id::VARCHAR', _text(key))} < {C.TAG_DROP_RATE} THEN NULL ELSE {value} END)"


def _style(get) -> str:  # noqa: ANN001
    def tag(label: str, key: str) -> str:
        return f"CASE WHEN coalesce({get(key)}, '') <> '' THEN ' {label}: ' || lower({get(key)}) || '.' ELSE '' END"

    line = f"replace({tag('Tone', 'tone')} || {tag('Writing Style', 'writing style')} || {tag('Genre', 'genre')}, '..', '.')"
    body = (
        f"CASE WHEN lower(coalesce({get('humor quality')}, '')) = 'high' THEN 'Humorously written ' ELSE 'Written ' END"
        f" || CASE WHEN coalesce({get('pacing')}, '') <> '' THEN 'with ' || lower({get('pacing')}) || ' pacing, ' ELSE '' END"
        f" || CASE WHEN lower({get('moment-to-moment detail')}) = 'high' THEN 'in moment to moment detail, ' ELSE '' END"
        f" || CASE WHEN coalesce({get('sensory detail')}, '') <> '' THEN 'in ' || lower({get('sensory detail')}) || ' detail, ' ELSE '' END"
        f" || CASE WHEN coalesce({get('point of view')}, '') <> '' THEN 'from a ' || {get('point of view')} || ' perspective.' ELSE '' END"
    )
    author = f"CASE WHEN coalesce({get('author')}, '') NOT IN ('', 'N/A') THEN ' In the style of ' || {get('author')} || '.' ELSE '' END"
    return _strip(f"({line} || chr(10) || regexp_replace({body}, ', $', '.') || {author})")


def _undo(x: str) -> str:
    flat = f"replace(replace(replace({x}, 'Write a scene where' || chr(10) || '-', 'Write a scene where: '), chr(10) || '-', ' '), '  ', ' ')"
    return f"CASE WHEN contains({x}, 'Write a scene where' || chr(10) || '-') THEN {flat} ELSE {x} END"


def _context(x: str) -> str:
    return f"CASE WHEN coalesce({_strip(x)}, '') <> '' AND {x} <> 'N\\A' THEN {x} END"


def _allowed(key: str) -> str:
    return _kept(key) if key in C.ALLOWED_FIELDS else "NULL"


_BUCKET = "CASE WHEN n < 300 THEN 'short' WHEN n < 500 THEN 'medium' WHEN n < 800 THEN 'large' WHEN n < 1000 THEN 'huge' ELSE 'massive' END"

_ROWS = f"""
  base AS (SELECT record_id, root, prompt, {_style(_allowed)} AS style, {_context(_kept('context'))} AS context,
    {_undo("coalesce(prompt['prompt'], '')")} AS ask, coalesce({_kept('story')}, '') AS output, coalesce(prompt['system suffix'], '') AS system FROM prompts),
  ready AS (SELECT *, {_strip("(style || chr(10) || ask)")} AS instruction, ({_tok("concat(style, context, ask, output, system)")} + {C.FORMAT_TOKENS}) AS tokens,
    {_tok('output')} AS n FROM base)"""


def _dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.dataset_rows(table(spark, sf_dir, "prompts"), ["record_id"])


# --- tokens ----------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {_tok('text')}::BIGINT AS tokens FROM documents")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", token_count(F.col("text")).cast("bigint").alias("tokens"))


@query(
    f"""SELECT record_id, md5(array_to_string(regexp_extract_all(coalesce(prompt['story'], ''), '{TOKEN}'), '|')) AS digest,
    coalesce(list_sum(list_transform({_lines("prompt['story']")}, lambda x: {_tok('x')})), 0)::BIGINT AS line_tokens FROM prompts"""
)
def token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    story = F.col("prompt")["story"]
    per_line = F.aggregate(lines(story), F.lit(0), lambda a, x: a + token_count(x))
    return table(spark, sf_dir, "prompts").select(
        "record_id", F.md5(F.array_join(tokens(F.coalesce(story, F.lit(""))), "|")).alias("digest"), F.coalesce(per_line, F.lit(0)).cast("bigint").alias("line_tokens")
    )


@query(f"SELECT record_id, {_BUCKET} AS bucket FROM (SELECT record_id, {_tok(chr(112) + 'rompt[' + chr(39) + 'story' + chr(39) + ']')} AS n FROM prompts)")
def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", rows.length_bucket(F.col("prompt")["story"]).alias("bucket"))


# --- phrases ---------------------------------------------------------------------------------------------------------


def _phrase_sql(source: str) -> str:
    body = "text"
    for c in C.CONTRACTIONS:
        body = f"replace({body}, {_text(c)}, {_text('’' + c[1:])})"
    return f"""src AS ({source}),
  sentences AS (SELECT story, unnest(list_filter(list_transform(string_split_regex({body}, {_text(C.PHRASE_BREAKS)}), lambda s: {_strip('s')}), lambda s: s <> '')) AS s FROM src),
  split AS (SELECT story, string_split(s, ' ') AS w FROM sentences),
  grams AS (SELECT story, unnest(list_transform(range(1, greatest(len(w) - 3, 0) + 1), lambda i: w[i:i + 2])) AS g FROM split),
  counts AS (SELECT story, replace(array_to_string(g, ' '), '’', '''') AS phrase, count(*) AS "count" FROM grams
    WHERE NOT list_has_any(g, {_list(C.PRONOUNS)}) AND len(list_filter(g, lambda x: regexp_matches(x, '{TITLE_CASE}'))) = 0 GROUP BY ALL)"""


_FULL = "CASE WHEN coalesce(prompt['context'], '') <> '' THEN prompt['context'] || chr(10) || prompt['story'] ELSE prompt['story'] END"


@query(f"WITH {_phrase_sql('SELECT book AS story, text FROM documents')} SELECT * FROM counts WHERE \"count\" >= {phrases.LEAST_IN_STORY}")
def top_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.frequent_in_story(phrases.story_phrases(table(spark, sf_dir, "documents"), "book", "text"))


def _prompt_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "prompts").select("story", records.full_text(F.col("prompt")).alias("text"))
    return phrases.story_phrases(texts, "story", "text")


@query(f"WITH {_phrase_sql(f'SELECT story, {_FULL} AS text FROM prompts')} SELECT * FROM counts WHERE \"count\" >= {phrases.LEAST_IN_STORY}")
def story_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.frequent_in_story(_prompt_phrases(spark, sf_dir))


@query(
    f"""WITH {_phrase_sql(f'SELECT story, {_FULL} AS text FROM prompts')}
  SELECT phrase, sum("count")::BIGINT AS "count", count(*) FILTER ("count" >= {phrases.LEAST_IN_STORY}) AS stories FROM counts GROUP BY phrase HAVING stories >= {phrases.LEAST_STORIES}"""
)
def phrases_min_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.frequent_overall(_prompt_phrases(spark, sf_dir))


# --- books -----------------------------------------------------------------------------------------------------------

_PARAGRAPHS = rf"""
  kept AS (SELECT book, list_filter(list_transform(string_split(replace(regexp_replace(replace(raw, chr(65533), ''), '^\x{{feff}}', ''), '’', ''''), chr(10)),
      lambda x: {_strip('x')}), lambda x: x <> '' AND NOT regexp_matches(x, '^\p{{N}}+$')) AS rows FROM books),
  folded AS (SELECT book, list_reduce(rows, lambda s, x: CASE
      WHEN starts_with(lower(x), 'chapter') THEN {{'cur': list_append(s.cur, chr(10)), 'out': s.out}}
      WHEN len(s.cur) = 0 AND NOT regexp_matches(x, '^[\p{{N}}\p{{Lu}}'']') THEN s
      WHEN regexp_matches(x, '[.?''"]$') AND NOT regexp_matches(x, '({'|'.join(t.replace('.', chr(92) + '.') for t in C.ABBREVIATED_TITLES)})$')
        THEN {{'cur': []::VARCHAR[], 'out': list_append(s.out, array_to_string(list_append(s.cur, x), ' '))}}
      ELSE {{'cur': list_append(s.cur, x), 'out': s.out}} END, {{'cur': []::VARCHAR[], 'out': []::VARCHAR[]}}) AS s FROM kept),
  parts AS (SELECT book, CASE WHEN len(s.cur) > 0 THEN list_append(s.out, array_to_string(s.cur, chr(10))) ELSE s.out END AS parts FROM folded)"""


@query(f"WITH {_PARAGRAPHS} SELECT book, i::BIGINT AS i, parts[i] AS paragraph FROM (SELECT book, parts, unnest(range(1, len(parts) + 1)) AS i FROM parts)")
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "books").select("book", F.posexplode(chunking.paragraphs(F.col("raw"))).alias("i", "paragraph"))
    return each.select("book", (F.col("i") + 1).cast("bigint").alias("i"), "paragraph")


def _short_sql(most: int) -> str:
    return f"short AS (SELECT book, list_filter(parts, lambda p: {_tok('p')} <= {most - 1}) AS p FROM parts)"


def _cut_sql(most: int) -> str:
    """Paragraphs cut by a recursion over their tokens: after a full stop, else before a blank, else at the bound."""
    at = most - 1
    return rf"""tok AS (SELECT book, i, regexp_extract_all(parts[i], '\s?[\p{{L}}\p{{M}}]+|\s?\p{{N}}|\s?[^\s\p{{L}}\p{{M}}\p{{N}}]|\s') AS x FROM (SELECT book, parts, unnest(range(1, len(parts) + 1)) AS i FROM parts)),
  cuts(book, i, x, k, a, b) AS (SELECT book, i, x, 0, 0::BIGINT, 0::BIGINT FROM tok UNION ALL
    SELECT book, i, x, k + 1, b, CASE WHEN len(x) - b <= {at} THEN len(x) ELSE b + coalesce(list_max(list_filter(range(1, {at + 1}), lambda j: x[b + j] = '.' OR regexp_matches(x[b + j + 1], '^\s'))), {at}) END FROM cuts WHERE b < len(x)),
  each_part AS (SELECT book, i, k, {_strip("array_to_string(x[a + 1:b], '')")} AS part FROM cuts WHERE k > 0),
  short AS (SELECT book, coalesce(list(part ORDER BY i, k) FILTER (part <> ''), []) AS p FROM each_part GROUP BY book)"""


def _chunk_sql(most: int, short: str) -> str:
    return f"""WITH RECURSIVE {_PARAGRAPHS},
  {short},
  packed AS (SELECT book, p, list_reduce(p, lambda s, x: CASE
      WHEN s.sum + {_tok('x')} + 1 < {most} THEN {{'sum': s.sum + {_tok('x')} + 1, 'n': s.n + 1, 'ids': list_append(s.ids, greatest(coalesce(s.ids[-1], 1), 1))}}
      ELSE {{'sum': {_tok('x')}, 'n': s.n + 1, 'ids': list_append(s.ids, coalesce(s.ids[-1], 0) + 1)}} END, {{'sum': 0::BIGINT, 'n': 0, 'ids': []::INT[]}}) AS s FROM short),
  each AS (SELECT book, p, s.ids AS ids, unnest(range(1, len(p) + 1)) AS i FROM packed)
  SELECT book, ids[i]::BIGINT AS chunk_id, string_agg(p[i], chr(10) ORDER BY i) AS text FROM each GROUP BY book, ids[i]"""


@query(_chunk_sql(CHUNK_TOKENS, _short_sql(CHUNK_TOKENS)))
def book_chunks_excluding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.book_chunks(table(spark, sf_dir, "books"), "book", "raw", CHUNK_TOKENS, exclude=True)


@query(_chunk_sql(CHUNK_TOKENS, _cut_sql(CHUNK_TOKENS)))
def book_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.book_chunks(table(spark, sf_dir, "books"), "book", "raw", CHUNK_TOKENS)


@query(
    f"""WITH l AS (SELECT record_id, {_lines("prompt['story']")} AS rows FROM prompts WHERE prompt['story'] IS NOT NULL),
  t AS (SELECT record_id, rows, list_transform(rows, lambda x: {_tok('x')}) AS size FROM l),
  f AS (SELECT record_id, rows, list_reduce(range(1, len(rows) + 1), lambda s, i: CASE
      WHEN s.tb <= s.tf THEN {{'front': s.front, 'back': s.back + 1, 'tf': s.tf, 'tb': s.tb + size[len(rows) - s.back]}}
      ELSE {{'front': s.front + 1, 'back': s.back, 'tf': s.tf + size[s.front + 1], 'tb': s.tb}} END, {{'front': 0::BIGINT, 'back': 0::BIGINT, 'tf': 0::BIGINT, 'tb': 0::BIGINT}}).front AS cut FROM t)
  SELECT record_id, md5(array_to_string(rows[1:cut], chr(10))) AS context, md5(array_to_string(rows[cut + 1:], chr(10))) AS story FROM f"""
)
def context_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    stories = table(spark, sf_dir, "prompts").select("record_id", F.col("prompt")["story"].alias("story")).filter("story IS NOT NULL")
    return stories.select("record_id", context.split_context(F.col("story")).alias("s")).select("record_id", F.md5("s.context").alias("context"), F.md5("s.story").alias("story"))


@query(f"SELECT record_id, (prompt['story'] IS NULL AND {_draw(chr(39) + '42' + chr(39), 'record_id::VARCHAR', chr(39) + 'continuation' + chr(39))} < 0.5) AS continues FROM prompts")
def continuation_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", context.continues(SEED, F.col("record_id").cast("string"), has_story=F.col("prompt")["story"].isNotNull()).alias("continues"))


# --- records ---------------------------------------------------------------------------------------------------------

_OBJECT = r"(CASE WHEN regexp_matches(raw, '^[ \t\n\r]*\{') AND json_valid(raw) THEN raw END)"


@query(
    f"""WITH r AS (SELECT story, chunk, {_OBJECT} AS j FROM raw_chunks)
  SELECT story, chunk, j IS NOT NULL AS is_record, coalesce(array_to_string(list_sort(json_keys(j)), '|'), '') AS keys, md5(coalesce(json_extract_string(j, '$.story'), '')) AS story_digest FROM r"""
)
def json_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = files.with_record(table(spark, sf_dir, "raw_chunks"))
    keys = F.coalesce(F.array_join(F.array_sort(F.map_keys("prompt")), "|"), F.lit(""))
    return rec.select("story", "chunk", F.col("prompt").isNotNull().alias("is_record"), keys.alias("keys"), F.md5(F.coalesce(F.col("prompt")["story"], F.lit(""))).alias("story_digest"))


@query(
    f"""WITH r AS (SELECT story, chunk, json_keys({_OBJECT}) AS k FROM raw_chunks)
  SELECT story, chunk, array_to_string(list_sort(list_distinct(list_transform(k, lambda x: lower({_strip('x')})))), '|') AS keys FROM r WHERE k IS NOT NULL"""
)
def normalised_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = files.with_record(table(spark, sf_dir, "raw_chunks")).filter("prompt IS NOT NULL")
    return rec.select("story", "chunk", F.array_join(F.array_sort(F.map_keys(records.normalise_keys(F.col("prompt")))), "|").alias("keys"))


@query(f"SELECT record_id, array_to_string(list_filter(map_keys(prompt), lambda k: k IN {_in(C.ALLOWED_FIELDS)}), '|') AS keys FROM prompts")
def allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", F.array_join(F.map_keys(records.only_keys(F.col("prompt"))), "|").alias("keys"))


@query(
    f"""WITH k AS (SELECT record_id, prompt, list_concat({_list(C.KEY_ORDER)}, list_sort(list_filter(map_keys(prompt), lambda k: k NOT IN {_in(C.KEY_ORDER)}))) AS keys FROM prompts)
  SELECT record_id, array_to_string(keys, '|') AS keys, md5(array_to_string(list_transform(keys, lambda k: coalesce(prompt[k], '<null>')), '|')) AS digest FROM k"""
)
def sort_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "prompts").select("record_id", records.ordered(F.col("prompt")).alias("p"))
    values = F.transform(F.map_values("p"), lambda v: F.coalesce(v, F.lit("<null>")))
    return got.select("record_id", F.array_join(F.map_keys("p"), "|").alias("keys"), F.md5(F.array_join(values, "|")).alias("digest"))


@query("SELECT record_id, array_to_string(list_filter(map_keys(prompt), lambda k: prompt[k] IS NOT NULL), '|') AS keys FROM prompts")
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", F.array_join(F.map_keys(records.without_nulls(F.col("prompt"))), "|").alias("keys"))


@query(
    """SELECT record_id, array_to_string(list_transform(list_filter(map_keys(prompt), lambda k: k NOT IN ('genre', 'context')), lambda k: CASE k WHEN 'tone' THEN 'mood' ELSE k END), '|') AS keys FROM prompts"""
)
def result_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = records.rename_keys(records.without_keys(F.col("prompt"), ["genre", "context"]), {"tone": "mood"})
    return table(spark, sf_dir, "prompts").select("record_id", F.array_join(F.map_keys(kept), "|").alias("keys"))


@query(f"SELECT record_id, md5({_FULL}) AS text, ({_context(chr(112) + 'rompt[' + chr(39) + 'context' + chr(39) + ']')}) IS NULL AS no_context FROM prompts")
def full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("prompt")
    return table(spark, sf_dir, "prompts").select("record_id", F.md5(records.full_text(p)).alias("text"), records.usable_context(p["context"]).isNull().alias("no_context"))


@query(
    """WITH e AS (SELECT story, chunk, CASE WHEN regexp_matches(raw, '^[ \\t\\n\\r]*\\{') AND json_valid(raw) THEN raw END AS j FROM raw_chunks)
  SELECT p.record_id, CASE WHEN list_contains(json_keys(e.j), 'prompt') THEN json_extract_string(e.j, '$.prompt') ELSE p.prompt['prompt'] END AS prompt_text,
    CASE WHEN list_contains(json_keys(e.j), 'male characters') THEN json_extract_string(e.j, '$."male characters"') ELSE p.prompt['male characters'] END AS males
  FROM prompts p JOIN e ON p.story = e.story AND p.chunk = e.chunk WHERE e.j IS NOT NULL"""
)
def overlay_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    extract = files.with_record(table(spark, sf_dir, "raw_chunks")).filter("prompt IS NOT NULL")
    base = table(spark, sf_dir, "prompts")
    tagged = base.select("story", "chunk", F.map_concat("prompt", F.create_map(F.lit("_id"), F.col("record_id").cast("string"))).alias("prompt"))
    got = records.merge_records(tagged, extract, ["story", "chunk"], ["prompt", "male characters"])
    return got.select(F.col("prompt")["_id"].cast("bigint").alias("record_id"), F.col("prompt")["prompt"].alias("prompt_text"), F.col("prompt")["male characters"].alias("males"))


@query(
    """SELECT p.record_id, CASE WHEN s.story IS NULL THEN p.prompt['author'] ELSE s.author END AS author, CASE WHEN s.story IS NULL THEN p.prompt['genre'] ELSE s.genre END AS genre,
    list_unique(list_concat(map_keys(p.prompt), CASE WHEN s.story IS NULL THEN []::VARCHAR[] ELSE ['author', 'genre'] END))::BIGINT AS n_keys
  FROM prompts p LEFT JOIN story_settings s ON p.story = s.story"""
)
def inject_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = records.inject(table(spark, sf_dir, "prompts"), table(spark, sf_dir, "story_settings"), "story", ["author", "genre"])
    p = F.col("prompt")
    return got.select("record_id", p["author"].alias("author"), p["genre"].alias("genre"), F.size("prompt").cast("bigint").alias("n_keys"))


_DELIMITER = "chr(10) || chr(10) || '---' || chr(10) || chr(10)"


@query(
    f"""WITH r AS (SELECT record_id, string_split(concat_ws({_DELIMITER}, prompt['context'], coalesce(prompt['prompt'], ''), coalesce(prompt['story'], '')), {_DELIMITER}) AS p FROM prompts)
  SELECT record_id, md5(coalesce(CASE len(p) WHEN 3 THEN p[1] END, '')) AS context, md5(coalesce(CASE len(p) WHEN 3 THEN p[2] WHEN 2 THEN p[1] END, '')) AS ask,
    md5(coalesce(CASE len(p) WHEN 3 THEN p[3] WHEN 2 THEN p[2] END, '')) AS story FROM r"""
)
def examples_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("prompt")
    raw = F.concat_ws("\n\n---\n\n", p["context"], F.coalesce(p["prompt"], F.lit("")), F.coalesce(p["story"], F.lit("")))
    got = table(spark, sf_dir, "prompts").select("record_id", records.parse_example(raw).alias("e"))
    return got.select("record_id", *(F.md5(F.coalesce(F.col("e")[k], F.lit(""))).alias(n) for k, n in (("context", "context"), ("prompt", "ask"), ("story", "story"))))


# --- rows and dataset ------------------------------------------------------------------------------------------------


@query(
    "SELECT record_id, md5(translate(coalesce(prompt['story'], ''), '“”', '\"\"')) AS story, md5(translate(coalesce(prompt['context'], ''), '“”', '\"\"')) AS context, "
    "md5(replace(coalesce(prompt['story'], ''), '’', '''')) AS straight FROM prompts"
)
def quote_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = rows.straight_quotes(F.col("prompt"))
    got = table(spark, sf_dir, "prompts").select("record_id", p.alias("p"), F.replace(F.coalesce(F.col("prompt")["story"], F.lit("")), F.lit("’"), F.lit("'")).alias("s"))
    return got.select("record_id", F.md5(F.coalesce(F.col("p")["story"], F.lit(""))).alias("story"), F.md5(F.coalesce(F.col("p")["context"], F.lit(""))).alias("context"), F.md5("s").alias("straight"))


def _contractions_sql() -> str:
    body = "coalesce(text, '')"
    for c in C.CONTRACTIONS:
        body = f"replace({body}, {_text(c)}, {_text('’' + c[1:])})"
    return f"SELECT doc_id, md5({body}) AS digest FROM documents"


@query(_contractions_sql())
def contraction_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = replace_all(F.coalesce(F.col("text"), F.lit("")), [(c, "’" + c[1:]) for c in C.CONTRACTIONS])
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(body).alias("digest"))


@query(f"SELECT record_id, {_undo(chr(112) + 'rompt[' + chr(39) + 'prompt' + chr(39) + ']')} AS ask FROM prompts")
def undo_hyphens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", rows.undo_hyphens(F.col("prompt")["prompt"]).alias("ask"))


@query(f"SELECT record_id, {_style(lambda k: f'prompt[{_text(k)}]')} AS style FROM prompts")
def prose_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", rows.prose_style(F.col("prompt")).alias("style"))


@query(
    f"""WITH e AS (SELECT record_id, prompt, list_filter(map_keys(prompt), lambda k: k NOT IN ('context', 'story', 'prompt') AND coalesce(prompt[k], '') <> '') AS keys FROM prompts),
  o AS (SELECT record_id, prompt, list_sort(list_transform(keys, lambda k: {{'at': {_bits("'42'", 'record_id::VARCHAR', 'k')}, 'k': k}})) AS o FROM e)
  SELECT record_id, {_strip("array_to_string(list_transform(o, lambda x: x.k || ': ' || lower(prompt[x.k]) || '. '), '')")} AS style FROM o"""
)
def plain_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", rows.plain_style(F.col("prompt"), SEED, F.col("record_id").cast("string")).alias("style"))


@query(
    f"""SELECT record_id, array_to_string(list_filter({_list(C.DROPPABLE_TAGS)}, lambda k: prompt[k] IS NOT NULL AND {_draw("'42'", 'record_id::VARCHAR', 'k')} >= 0.5), '|') AS tags FROM prompts"""
)
def tag_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = rows.drop_tags(records.without_nulls(F.col("prompt")), SEED, F.col("record_id").cast("string"))
    order = F.array(*map(F.lit, C.DROPPABLE_TAGS))
    return table(spark, sf_dir, "prompts").select("record_id", F.array_join(F.filter(order, lambda k: F.array_contains(F.map_keys(kept), k)), "|").alias("tags"))


@query(f"WITH {_ROWS} SELECT record_id, system, md5(coalesce(context, '')) AS context, md5(instruction) AS instruction, md5(output) AS output, {_BUCKET} AS length, tokens::BIGINT AS tokens FROM ready")
def dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _dataset(spark, sf_dir)
    return got.select("record_id", "system", F.md5(F.coalesce("context", F.lit(""))).alias("context"), F.md5("instruction").alias("instruction"), F.md5("output").alias("output"), "length", F.col("tokens").cast("bigint").alias("tokens"))


def _render_sql() -> str:
    def fill(name: str) -> str:
        parts = C.TRAINING_FORMAT[name].split("%")
        return " || ".join(p if k % 2 else _text(p) for k, p in enumerate(parts))

    return f"""WITH {_ROWS} SELECT record_id, md5(CASE WHEN context IS NOT NULL THEN {fill('system,context,instruction,output')} ELSE {fill('system,instruction,output')} END) AS digest FROM ready"""


@query(_render_sql())
def render_training_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _dataset(spark, sf_dir)
    return got.select("record_id", F.md5(rows.render_training_text(*map(F.col, ("system", "context", "instruction", "output")))).alias("digest"))


@query(f"WITH {_ROWS} SELECT record_id, tokens::BIGINT AS tokens FROM ready WHERE tokens BETWEEN 200 AND 400")
def token_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.token_range(_dataset(spark, sf_dir), 200, 400).select("record_id", F.col("tokens").cast("bigint").alias("tokens"))


@query(
    f"""WITH r AS (SELECT record_id, row_number() OVER (ORDER BY {_bits("'42'", 'record_id::VARCHAR')}, record_id) AS place, count(*) OVER () AS n FROM prompts)
  SELECT record_id, place <= floor(0.1 * n) AS is_validation FROM r"""
)
def val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.exact_split(table(spark, sf_dir, "prompts").select("record_id"), "record_id")


_METRIC_KEYS = [k for k in C.ALLOWED_FIELDS if k not in C.METRIC_SKIPPED]


def _metric_sql() -> str:
    per_key = " UNION ALL ".join(f"SELECT {_text(k)} AS field, {_kept(k)} AS v FROM prompts" for k in _METRIC_KEYS)
    length = f"SELECT 'length' AS field, {_BUCKET} AS v FROM ready"
    return f"""WITH {_ROWS}, e AS (SELECT field, regexp_replace(v, '\\.$', '') AS v FROM ({per_key} UNION ALL {length}) WHERE coalesce(v, '') <> ''),
  p AS (SELECT field, v, string_split(v, ',') AS parts FROM e),
  x AS (SELECT field, unnest(CASE WHEN field = 'point of view' THEN [string_split(v, '(')[1]]
      WHEN len(list_filter(parts, lambda q: contains(q, 'and'))) > 0 THEN flatten(list_transform(parts, lambda q: string_split(q, 'and'))) ELSE parts END) AS value FROM p)
  SELECT field, lower({_strip('value')}) AS value, count(*) AS "count" FROM x GROUP BY ALL HAVING count(*) > {C.METRIC_LEAST}"""


@query(_metric_sql())
def tag_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.tag_metrics(_dataset(spark, sf_dir))


@query(
    f"""WITH {_ROWS}, s AS (SELECT root, count(*) AS n, sum(tokens) AS v FROM ready WHERE root IS NOT NULL GROUP BY root),
  l AS (SELECT list(root ORDER BY root) AS names FROM s), m AS (SELECT names, unnest(range(1, (1 << len(names))::BIGINT)) AS mask FROM l),
  q AS (SELECT list_filter(names, lambda x: (mask >> (list_position(names, x) - 1)) & 1 = 1) AS names FROM m)
  SELECT array_to_string(names, '_') AS subset, sum(n)::BIGINT AS n_rows, sum(v)::BIGINT AS total FROM q JOIN s ON list_contains(names, root) GROUP BY names"""
)
def dataset_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # draws depend on the record alone, so a row is the same in every subset
    made = rows.dataset_rows(table(spark, sf_dir, "prompts"), ["record_id"], keep=["root"])
    return dataset.subset_totals(made.select("root", F.col("tokens").cast("bigint").alias("tokens")), "root", "tokens")


# --- tags and names --------------------------------------------------------------------------------------------------


def _alias_sql(key: str) -> str:
    v, names = f"prompt['{key}']", C.ALIASES[key]
    mapping = f"MAP {{{', '.join(f'{_text(a)}: {_text(b)}' for a, b in names.items())}}}"
    low = f"regexp_replace(lower({v}), '^\\.+|\\.+$', '', 'g')"
    joined = f"CASE WHEN contains({low}, ' and ') THEN replace(replace({low}, ' and ', ', and '), ',,', ',') ELSE {low} END"
    parts = f"list_transform(string_split(replace({joined}, 'with a touch of ', ','), ','), lambda p: {_strip('p')})"
    tidy = f"list_concat(({parts})[1:-2], [regexp_replace(({parts})[-1], '^and ', '')])"
    mapped = f"list_transform({tidy}, lambda p: coalesce({mapping}[p], p))"
    first = f"list_filter({mapped}, lambda p, i: list_position({mapped}, p) = i)"
    return f"CASE WHEN coalesce({v}, '') = '' THEN {v} WHEN {mapping}[{low}] IS NOT NULL THEN {mapping}[{low}] WHEN contains({low}, ',') THEN array_to_string({first}, ', ') ELSE {v} END"


@query(f"SELECT record_id, {_alias_sql('tone')} AS tone, {_alias_sql('writing style')} AS writing_style, {_alias_sql('sensory detail')} AS sensory_detail FROM prompts")
def alias_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = tags.alias_record(F.col("prompt"))
    return table(spark, sf_dir, "prompts").select("record_id", p.alias("p")).select("record_id", F.col("p")["tone"].alias("tone"), F.col("p")["writing style"].alias("writing_style"), F.col("p")["sensory detail"].alias("sensory_detail"))


_POPULAR = f"""each AS (SELECT record_id, i, {_strip('w')} AS writer FROM (SELECT record_id, unnest(string_split(prompt['similar writers'], ',')) AS w,
      unnest(range(1, len(string_split(prompt['similar writers'], ',')) + 1)) AS i FROM prompts)),
  popular AS (SELECT lower(writer) AS name, count(*) AS n FROM each WHERE writer <> '' GROUP BY ALL)"""


@query(f"WITH {_POPULAR} SELECT * FROM popular")
def author_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.popularity(table(spark, sf_dir, "prompts"))


@query(
    f"""WITH {_POPULAR},
  silent AS (SELECT record_id FROM prompts WHERE coalesce(prompt['author'], '') = '' AND coalesce(prompt['similar writers'], 'N/A') <> 'N/A'),
  found AS (SELECT e.record_id, e.i, e.writer, p.n FROM each e JOIN popular p ON lower(e.writer) = p.name JOIN silent USING (record_id) WHERE p.n > 1 AND e.writer <> 'N/A'),
  sums AS (SELECT *, sum(n) OVER (PARTITION BY record_id) AS total, count(*) OVER (PARTITION BY record_id) AS k, {_draw("'42'", 'record_id::VARCHAR', "'author'")} AS pos FROM found),
  steps AS (SELECT *, sum(total - n) OVER (PARTITION BY record_id ORDER BY i) AS upto FROM sums),
  pick AS (SELECT record_id, coalesce(arg_min(writer, i) FILTER (k = 1 OR pos * total * (k - 1) < upto), arg_max(writer, i)) AS author FROM steps GROUP BY record_id)
  SELECT record_id, coalesce(author, 'N/A') AS author FROM silent LEFT JOIN pick USING (record_id)"""
)
def narrow_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = table(spark, sf_dir, "prompts")
    return tags.narrow_authors(prompts, tags.popularity(prompts), "record_id", least=1)


def _names_sql(key: str) -> str:
    v = f"coalesce(prompt['{key}'], '')"
    return f"CASE WHEN {v} = '' THEN []::VARCHAR[] ELSE list_transform(list_filter(string_split({v}, ','), lambda n: len(list_filter(string_split(n, ' '), lambda p: p <> '' AND p = lower(p))) = 0), lambda n: {_strip('n')}) END"


@query(f"SELECT record_id, array_to_string({_names_sql('male characters')}, '|') AS males, array_to_string({_names_sql('female characters')}, '|') AS females FROM prompts")
def parse_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("prompt")
    return table(spark, sf_dir, "prompts").select("record_id", F.array_join(names.parse_names(p["male characters"]), "|").alias("males"), F.array_join(names.parse_names(p["female characters"]), "|").alias("females"))


def _sample_sql(pool: list[str], count: str, role: str) -> str:
    ranked = f"list_sort(list_transform({_list(pool)}, lambda n: {{'at': md5(concat_ws('|', '42', record_id::VARCHAR, '{role}', n)), 'name': n}}))"
    return f"list_transform(({ranked})[1:len({count})], lambda s: s.name)"


_SWAPS = f"""
  parsed AS (SELECT record_id, root, story, chunk, prompt, {_names_sql('male characters')} AS m, {_names_sql('female characters')} AS f FROM prompts),
  drawn AS (SELECT *, list_concat(m, f) AS names, list_concat({_sample_sql(C.MALE_NAMES, 'm', 'male first')}, {_sample_sql(C.FEMALE_NAMES, 'f', 'female first')}) AS first,
    list_concat({_sample_sql(C.MALE_NAMES, 'm', 'male last')}, {_sample_sql(C.FEMALE_NAMES, 'f', 'female last')}) AS last FROM parsed),
  swapped AS (SELECT *, list_transform(names, lambda n, i: {{'name': n, 'parts': string_split(n, ' '), 'head': string_split(n, ' ')[1], 'nf': first[i], 'nl': last[i]}}) AS s0 FROM drawn),
  swaps AS (SELECT *, list_transform(s0, lambda s: {{'name': s.name,
      'fo': CASE WHEN s.head IN {_in(C.TITLES)} THEN '' WHEN ends_with(s.head, '''s') THEN s.head[:-3] WHEN s.head IN {_in(C.NAME_BLACKLIST)} THEN '' ELSE s.head END, 'fn': s.nf,
      'lo': CASE WHEN s.head NOT IN {_in(C.TITLES)} AND (ends_with(s.head, '''s') OR s.head IN {_in(C.NAME_BLACKLIST)}) THEN '' WHEN len(s.parts) = 2 THEN s.parts[2] ELSE '' END, 'ln': s.nl}}) AS s FROM swapped)"""

_FORMS = (
    "list_filter(flatten(list_transform(s, lambda x: [{'o': x.fo, 'n': x.fn}, {'o': upper(x.fo), 'n': upper(x.fn)}, {'o': x.fo[1] || '-' || x.fo, 'n': x.fn[1] || '-' || x.fn},"
    " {'o': x.lo, 'n': x.ln}, {'o': upper(x.lo), 'n': upper(x.ln)}, {'o': x.lo[1] || '-' || x.lo, 'n': x.ln[1] || '-' || x.ln}])), lambda p: p.o NOT IN ('', '-'))"
)


@query(
    f"""WITH {_SWAPS}, pairs AS (SELECT record_id, prompt, {_FORMS} AS pairs FROM swaps)
  SELECT record_id, md5(coalesce(list_reduce(pairs, lambda a, p: {{'o': replace(a.o, p.o, p.n), 'n': ''}}, {{'o': prompt['story'], 'n': ''}}).o, '')) AS story,
    list_reduce(pairs, lambda a, p: {{'o': replace(a.o, p.o, p.n), 'n': ''}}, {{'o': prompt['male characters'], 'n': ''}}).o AS males FROM pairs"""
)
def randomize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = names.randomize_names(table(spark, sf_dir, "prompts"), ["record_id"])
    return got.select("record_id", F.md5(F.coalesce(F.col("prompt")["story"], F.lit(""))).alias("story"), F.col("prompt")["male characters"].alias("males"))


@query(
    f"""WITH {_SWAPS}, each AS (SELECT record_id, unnest(s) AS s, unnest(range(len(s))) AS i FROM swaps),
  one AS (SELECT record_id, i, s.name AS old_name, CASE WHEN s.fo <> '' THEN replace(s.name, s.fo, s.fn) ELSE s.name END AS half, s FROM each),
  two AS (SELECT record_id, i, old_name, CASE WHEN s.lo <> '' THEN replace(half, s.lo, s.ln) ELSE half END AS new_name FROM one)
  SELECT old_name, arg_max(new_name, record_id * 1000 + i) AS new_name FROM two WHERE old_name <> new_name GROUP BY old_name"""
)
def replaced_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.replaced_names(names.randomize_names(table(spark, sf_dir, "prompts"), ["record_id"]), ["record_id"])


# --- few-shot and generation -----------------------------------------------------------------------------------------

_PARSED = rf"""
  l AS (SELECT doc_id, {_lines('text')} AS rows FROM documents WHERE text IS NOT NULL),
  n AS (SELECT doc_id, unnest(rows) AS line, unnest(range(1, len(rows) + 1)) AS i FROM l),
  k AS (SELECT *, {_strip('line')} = '' AS is_blank, starts_with(line, '>') AND contains(line, ':') AS is_key FROM n),
  g AS (SELECT *, sum(is_blank::INT) OVER (PARTITION BY doc_id ORDER BY i) AS ex, sum(is_key::INT) OVER (PARTITION BY doc_id ORDER BY i) AS kk FROM k),
  h AS (SELECT *, max(is_key::INT) OVER (PARTITION BY doc_id, ex ORDER BY i) AS begun FROM g WHERE NOT is_blank),
  e AS (SELECT doc_id, ex, kk, {_strip("regexp_extract(min(line) FILTER (is_key), '^>([^:]*):', 1)")} AS key,
      string_agg(CASE WHEN is_key THEN regexp_replace(regexp_replace(line, '^>[^:]*:', ''), '^ ', '') ELSE line END, chr(10) ORDER BY i) AS value FROM h WHERE begun = 1 GROUP BY doc_id, ex, kk),
  u AS (SELECT doc_id, ex, key, min(kk) AS pos, arg_max(value, kk) AS value FROM e GROUP BY doc_id, ex, key)"""


@query(
    f"""WITH {_PARSED}, x AS (SELECT doc_id, ex, string_agg(key, '|' ORDER BY pos) AS keys, md5(string_agg(value, '|' ORDER BY pos)) AS digest FROM u GROUP BY doc_id, ex)
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ex) AS example, keys, digest FROM x"""
)
def fewshot_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(fewshot.parse(F.col("text"))).alias("i", "m"))
    return got.select("doc_id", (F.col("i") + 1).cast("bigint").alias("example"), F.array_join(F.map_keys("m"), "|").alias("keys"), F.md5(F.array_join(F.map_values("m"), "|")).alias("digest"))


@query(
    f"""WITH {_PARSED}, x AS (SELECT doc_id, ex, string_agg('>' || key || ': ' || value, chr(10) ORDER BY pos) FILTER (key NOT IN ('Story', 'Tone')) AS t FROM u GROUP BY doc_id, ex)
  SELECT doc_id, md5(string_agg(coalesce(t, ''), chr(10) || chr(10) ORDER BY ex)) AS digest FROM x GROUP BY doc_id"""
)
def fewshot_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "documents").filter(F.size(fewshot.parse(F.col("text"))) > 0)
    return got.select("doc_id", F.md5(fewshot.edit(F.col("text"), ["Story", "Tone"])).alias("digest"))


@query(
    "SELECT record_id, md5('>Story: ' || prompt['story'] || chr(10) || '>Context: ' || coalesce(prompt['context'], 'N/A') || chr(10) || '>Language: English') AS digest FROM prompts WHERE prompt['story'] IS NOT NULL"
)
def fewshot_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "prompts").filter(F.col("prompt")["story"].isNotNull())
    return got.select("record_id", F.md5(fewshot.render(TEMPLATE, {"story": F.col("prompt")["story"], "context": F.coalesce(F.col("prompt")["context"], F.lit("N/A"))})).alias("digest"))


@query(
    """SELECT record_id, coalesce(cardinality(prompt) = 0 OR len(list_filter(map_values(prompt), lambda v: v IS NULL OR len(v) < 2 OR contains(v, 'N/A') OR contains(v, 'fiddler'))) > 0, true) AS junk FROM prompts"""
)
def junk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", generation.is_junk(F.col("prompt"), ["N/A", "fiddler"]).alias("junk"))


@query(
    f"""WITH t AS (SELECT record_id, coalesce(list_sum(list_transform(map_values(prompt), lambda v: {_tok('v')})), 0) AS n FROM prompts)
  SELECT record_id, n::BIGINT AS tokens, abs({C.IDEAL_TOKENS} - n) < {C.IDEAL_TOKENS} AS acceptable FROM t"""
)
def result_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "prompts").select("record_id", generation.result_tokens(F.col("prompt")).cast("bigint").alias("tokens"), generation.acceptable(F.col("prompt")).alias("acceptable"))
    return got


def _answered(spark: SparkSession, sf_dir: str, reply=">Prompt: Write a scene\n>Tone: neutral") -> DataFrame:  # noqa: ANN001
    chunks = files.with_record(table(spark, sf_dir, "raw_chunks"))
    return generation.chunk_records(generation.ask_for_chunks(chunks, ["story", "chunk"], TEMPLATE, generation.StubClient(reply), seed=SEED))


@query()
def generate_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _answered(spark, sf_dir)
    return made.select("story", "chunk", "attempts", F.to_json(records.ordered(F.col("prompt")), {"ignoreNullFields": "false"}).alias("record"), "reason", "junk")


_SPLIT_SQL = f"""rows AS (SELECT *, {_lines('raw')} AS l FROM halves), sizes AS (SELECT *, list_transform(l, lambda x: {_tok('x')}) AS size FROM rows),
  cutat AS (SELECT *, list_reduce(range(1, len(l) + 1), lambda s, i: CASE
      WHEN s.tb <= s.tf THEN {{'front': s.front, 'back': s.back + 1, 'tf': s.tf, 'tb': s.tb + size[len(l) - s.back]}}
      ELSE {{'front': s.front + 1, 'back': s.back, 'tf': s.tf + size[s.front + 1], 'tb': s.tb}} END, {{'front': 0::BIGINT, 'back': 0::BIGINT, 'tf': 0::BIGINT, 'tb': 0::BIGINT}}).front AS cutpos FROM sizes)"""

# the stub answers every request alike, with a prompt and a tone
_GENERATED = f"""WITH known AS (SELECT story, chunk, raw, {_OBJECT} AS j FROM raw_chunks),
  halves AS (SELECT *, coalesce(len(json_keys(j)), 0) > 0 AS holds, coalesce(list_contains(json_keys(j), 'story'), false) AS redone,
    coalesce(len(json_keys(j)), 0) = 0 AND {_draw("'42'", "concat_ws('/', story, chunk)", "'continuation'")} < {C.CONTINUATION_RATE} AS split FROM known),
  {_SPLIT_SQL},
  told AS (SELECT story, chunk, j, holds, split,
    CASE WHEN split THEN array_to_string(l[1:cutpos], chr(10)) ELSE coalesce(CASE WHEN redone THEN json_extract_string(j, '$.context') END, 'N/A') END AS before,
    CASE WHEN split THEN array_to_string(l[cutpos + 1:], chr(10)) WHEN redone THEN json_extract_string(j, '$.story') WHEN NOT holds THEN raw END AS told FROM cutat),
  asked AS (SELECT *, '>Story: ' || told || chr(10) || '>Context: ' || before || chr(10) || '>Language: English' AS request FROM told),
  sent AS (SELECT *, {_tok('request')} + 600 <= 8192 AS fits, {_tok(_strip('told'))} + CASE WHEN split THEN {_tok(_strip('before'))} ELSE 0 END AS n FROM asked),
  done AS (SELECT *, CASE WHEN fits AND request IS NOT NULL THEN 1 ELSE 0 END::BIGINT AS attempts FROM sent),
  judged AS (SELECT *, CASE WHEN NOT fits THEN 'window' WHEN attempts = 0 THEN 'unanswered' WHEN NOT abs({C.IDEAL_TOKENS} - (n + ANSWER)) < {C.IDEAL_TOKENS} THEN 'length' END AS reason FROM done)"""


@query(
    _GENERATED.replace("ANSWER", "4")
    + f""", keyed AS (SELECT *, list_concat({_list(C.KEY_ORDER)}, list_sort(list_filter(coalesce(json_keys(j), []), lambda k: k NOT IN {_in(C.KEY_ORDER)}))) AS keys FROM judged)
  SELECT story, chunk, attempts, reason, CASE WHEN reason IS NULL THEN array_to_string(keys, '|') END AS keys,
    CASE WHEN reason IS NULL THEN md5(array_to_string(list_transform(keys, lambda k: coalesce(CASE WHEN k = 'prompt' THEN 'Write a scene' WHEN k = 'tone' THEN 'neutral' WHEN k = 'story' THEN {_strip('told')}
      WHEN k = 'context' AND split THEN {_strip('before')} ELSE json_extract_string(j, '$."' || k || '"') END, '<null>')), '|')) END AS digest FROM keyed"""
)
def generate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _answered(spark, sf_dir).withColumn("record", records.ordered(F.col("prompt")))
    values = F.transform(F.map_values("record"), lambda v: F.coalesce(v, F.lit("<null>")))
    return made.select("story", "chunk", "attempts", "reason", F.when(F.col("record").isNotNull(), F.array_join(F.map_keys("record"), "|")).alias("keys"), F.when(F.col("record").isNotNull(), F.md5(F.array_join(values, "|"))).alias("digest"))


@query(_GENERATED.replace("ANSWER", "0") + " SELECT story, chunk, CASE WHEN fits AND request IS NOT NULL THEN 3 ELSE 0 END::BIGINT AS attempts, CASE WHEN NOT fits THEN 'window' WHEN attempts = 0 THEN 'unanswered' ELSE 'junk' END AS reason, CASE WHEN attempts = 0 THEN 0 ELSE 3 END::BIGINT AS n_junk FROM judged")
def generate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a model whose every answer is junk: nothing is lost, each chunk comes back with the reason and the answers
    made = _answered(spark, sf_dir, ">Prompt: x")
    return made.filter("reason IS NOT NULL").select("story", "chunk", "attempts", "reason", F.size("junk").cast("bigint").alias("n_junk"))


@query()
def screenplays(spark: SparkSession, sf_dir: str) -> DataFrame:
    # screenplays of the corpus written back as scripts: speakers as name tags, speech in quotes
    body = F.regexp_replace("text", r"(?m)^([A-Z]{3,})( .*)?$", '@nm t="$1" s=x')
    made = table(spark, sf_dir, "documents").filter(F.col("text").rlike(r"^\[(INT|EXT)")).select("doc_id", F.regexp_replace(body, r"(?m)^\[(INT|EXT)\. (.*)\]$", C.LOCATION_MARK + "$2").alias("script"))
    return screenplay.screenplay_chunks(made, "doc_id", "script", 200)


# --- joins, grid, order ----------------------------------------------------------------------------------------------


@query("SELECT r.story, r.chunk, r.arrived_at FROM raw_chunks r WHERE NOT EXISTS (SELECT 1 FROM prompts p WHERE p.story = r.story AND p.chunk = replace(r.chunk, '.txt', '.json'))")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.unprocessed(table(spark, sf_dir, "raw_chunks"), table(spark, sf_dir, "prompts")).select("story", "chunk", "arrived_at")


@query("SELECT DISTINCT story FROM prompts WHERE story IS NOT NULL AND story NOT IN (SELECT story FROM story_settings WHERE story IS NOT NULL)")
def new_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.new_stories(table(spark, sf_dir, "prompts"), table(spark, sf_dir, "story_settings"))


@query(
    """WITH n AS (SELECT list(n_name ORDER BY n_name) AS l FROM nation), r AS (SELECT list(r_name ORDER BY r_name) AS l FROM region)
  SELECT a AS nation, b AS region, t::INT AS trial, 'From ' || a || ' in ' || b || '.' AS prompt,
    'nation' || (list_position(n.l, a) - 1) || '_region' || (list_position(r.l, b) - 1) || '__trial' || t || '.txt' AS out_file
  FROM n, r, unnest(n.l) AS x(a), unnest(r.l) AS y(b), range(2) AS z(t)"""
)
def template_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the lists stand in for a configuration file: 25 and 5 names at every size
    lists = {k: sorted(r[0] for r in table(spark, sf_dir, k).select(f"{k[0]}_name").collect()) for k in ("nation", "region")}
    return grid.template_grid(spark, "From {nation} in {region}.", lists, 2)


@query(f"SELECT record_id, {_bits(chr(39) + '42' + chr(39), 'record_id::VARCHAR')} AS at, md5(prompt['story']) AS story FROM prompts WHERE prompt['story'] IS NOT NULL")
def stories_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "prompts").filter(F.col("prompt")["story"].isNotNull()).select("record_id", draw_bits(SEED, F.col("record_id").cast("string")).alias("at"), F.md5(F.col("prompt")["story"]).alias("story"))
    return got.orderBy("at", "record_id")


@query(f"SELECT DISTINCT story, {_strip('story')} AS name FROM raw_chunks UNION SELECT DISTINCT story, {_strip('story')} AS name FROM prompts")
def all_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "raw_chunks").select("story").unionByName(table(spark, sf_dir, "prompts").select("story"))
    return both.distinct().select("story", strip(F.col("story")).alias("name"))
