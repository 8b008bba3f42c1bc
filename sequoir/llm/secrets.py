"""Secret scans, native: what a candidate's value is worth depends on who else has it.

Candidates are assignments to telling names, access keys, long hexadecimal runs
and, as a looser kind, runs of a credential's characters with letters and
digits. Their values' hashes are counted over the corpus by distinct
repositories and owners: what many owners have is a copied example; what few
have is theirs. A loose run counts as found if few owners have its value and it
either stands elsewhere as a named credential or looks random by itself. All of it is DataFrame
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sequoir.llm.common import forget, materialise

#: A value that so many owners have is an example that is copied widely.
EXAMPLE_OWNERS = 3
#: Fewest characters of a loose run; of one that looks random by itself, and its distinct characters.
LOOSE_CHARS, RANDOM_CHARS, RANDOM_DISTINCT = 8, 20, 12
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "loose")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: What names a secret, in either case of its letters.
NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: A run with a digit, from its first character on.
LOOSE = r"[A-Za-z+/_.-]*[0-9][A-Za-z0-9+/_.-]*"
#: The same for an engine that would try each of a run's characters as its start, or walk back.
LOOSE_ONCE = r"(?<![A-Za-z0-9+/_.-])[A-Za-z+/_.-]*+[0-9][A-Za-z0-9+/_.-]*+"


def _found(text: Column, kind: int, pattern: str, value: int = 0) -> Column:
    """ord, gap, chars, value of a pattern's matches: gap is what lies between a match and the one before."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), (F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else whole).alias("value"))
    row = lambda x, k: F.struct(F.lit(kind).alias("kind"), k.alias("ord"), x["gap"].alias("gap"), F.length(x["whole"]).alias("chars"), x["value"].alias("value"))
    rows = F.filter(F.transform(zipped, row), lambda x: x["chars"].isNotNull())
    return F.when(text.rlike(pattern), rows)


def candidates(docs: DataFrame, repo: str, owner: str) -> DataFrame:
    """row, doc_id, and found: the matches of all kinds, of every row of docs (doc_id, text, repo, owner)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = [_found(text, 0, ASSIGN, 2), _found(text, 1, ACCESS), _found(text, 2, HEX), _found(text, 3, LOOSE_ONCE)]
    empty = F.array().cast("array<struct<kind:int,ord:int,gap:int,chars:int,value:string>>")
    found = F.concat(*(F.coalesce(k, empty) for k in kinds))
    named = docs.select(F.col("doc_id").alias("doc_id"), F.col(repo).alias("repo"), F.col(owner).alias("owner"), found.alias("found"))
    return named.select(F.monotonically_increasing_id().alias("row"), "*")


def spans(found: DataFrame) -> DataFrame:
    """row, doc_id, repo, owner, kind, start, end, value of the candidates that pass their kind's rule and overlap no base one if loose.

    A row's matches are placed by adding up their lengths and the gaps between
    them, in one sorted window.
    """
    each = found.select("row", "doc_id", "repo", "owner", F.explode("found").alias("x")).select("row", "doc_id", "repo", "owner", "x.*")
    placed = Window.partitionBy("row", "kind").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("chars")).over(placed)).withColumn("start", F.col("end") - F.col("chars"))
    # a loose run may end in what closes a sentence
    value = F.when(F.col("kind") < 3, F.col("value")).otherwise(F.rtrim(F.col("value"), F.lit(".")))
    each = each.withColumn("end", F.col("end") - F.col("chars") + F.when(F.col("kind") < 3, F.col("chars")).otherwise(F.length(value))).withColumn("value", value)
    named = (F.col("kind") > 0) | (F.length("value") >= 8)
    loose = (F.length("value") >= LOOSE_CHARS) & F.col("value").rlike("[A-Za-z]")
    each = each.where(F.when(F.col("kind") < 3, named).otherwise(loose))
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    base = lambda c: F.when(F.col("kind") < 3, F.col(c))
    clear = (F.coalesce(F.max(base("end")).over(before), F.lit(0)) <= F.col("start")) & (F.coalesce(F.min(base("start")).over(after), F.col("end")) >= F.col("end"))
    return each.withColumn("clear", clear).where((F.col("kind") < 3) | F.col("clear")).select("row", "doc_id", "repo", "owner", "kind", F.col("start").cast("long"), F.col("end").cast("long"), "value")


def _compared(value: Column) -> Column:
    """A value without the padding and dots that may end it."""
    return F.rtrim(value, F.lit(".="))


def ownership(rows: DataFrame) -> DataFrame:
    """hash, chars, n_repos, n_owners, n_named of the values of spans' rows: distinct repositories and owners, and how often a base kind has the value.

    Equal (value, owner, repository) rows are added up in the tasks first, then
    by repository, owner and value, so that a value that everybody has is no
    large group at any step.
    """
    base = F.sum((F.col("kind") < 3).cast("long")).alias("named")
    by_repo = rows.groupBy("hash", "chars", "owner", "repo").agg(base)
    #: an owner's repositories may be another owner's too: both are counted apart
    by_owner = by_repo.groupBy("hash", "chars", "owner").agg(F.sum("named").alias("named")).groupBy("hash", "chars").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("named").alias("n_named"))
    repos = by_repo.select("hash", "chars", "repo").distinct().groupBy("hash", "chars").agg(F.count(F.lit(1)).alias("n_repos"))
    return by_owner.join(repos, ["hash", "chars"])


def judged(docs: DataFrame, repo: str = "doc_id", owner: str = "source") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row of docs as row and doc_id; and row, kind, start, end, value, n_repos, n_owners, n_named, verdict.

    verdict: `example` if at least EXAMPLE_OWNERS owners have the value, else
    `live`. Loose runs are in only if they are live and either named elsewhere
    or random by their looks. Both are read from tables in the shared folder.
    """
    found = materialise(candidates(docs, repo, owner), "candidates")
    key = _compared(F.col("value"))
    placed = materialise(spans(found).withColumn("hash", F.xxhash64(key)).withColumn("chars", F.length(key)), "spans")
    known = ownership(placed)
    rated = placed.join(known, ["hash", "chars"])
    random = (
        (F.length("value") >= RANDOM_CHARS)
        & F.col("value").rlike("[A-Z]")
        & F.col("value").rlike("[a-z]")
        & (F.size(F.array_distinct(F.split("value", ""))) >= RANDOM_DISTINCT)
    )
    verdict = F.when(F.col("n_owners") >= EXAMPLE_OWNERS, "example").otherwise("live")
    rated = rated.withColumn("verdict", verdict).where((F.col("kind") < 3) | ((F.col("verdict") == "live") & ((F.col("n_named") > 0) | random)))
    return found.select("row", "doc_id", (F.size("found") > 0).alias("any")), rated


def secret_spans(docs: DataFrame, repo: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, kind, start, end, value, n_repos, n_owners, verdict of every secret that is found."""
    _, rated = judged(docs, repo, owner)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return rated.select("doc_id", kind.alias("kind"), "start", "end", "value", "n_repos", "n_owners", "verdict")


def scan(docs: DataFrame, repo: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example of every row of docs (doc_id, text, repo, owner).

    Texts that are null count as empty; null repositories and owners count as
    one each; rows with null or equal ids and repeated rows each get a row, and
    are one repository if their repo is equal. An empty table gives no rows;
    other columns aren't read. Spans are in code points. A long text's matches
    are one row until they are placed, then rows, which a sorted window places;
    memory is in proportion to the longest text. Rows without any match are not
    shuffled. What is read and placed stays in the shared folder as long as the result is used.
    """
    rows, rated = judged(docs, repo, owner)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    written = F.concat_ws(":", kind, F.col("start").cast("string"), F.col("end").cast("string"))
    each = rated.select("row", F.struct("start", "kind", written.alias("span")).alias("x"), "verdict")
    joined = lambda base: F.array_join(F.transform(F.filter(F.array_sort(F.collect_list("x")), lambda x: (x["kind"] < 3) | F.lit(not base)), lambda x: x["span"]), ",")
    count = lambda what: F.sum(what.cast("long"))
    digests = each.groupBy("row").agg(
        *(count(F.col("x.kind") == k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])),
        F.sha2(joined(True), 256).alias("base_sha256"),
        joined(False).alias("spans"),
        count(F.col("verdict") == "live").alias("n_live"),
        count(F.col("verdict") == "example").alias("n_example"),
    )
    some = rows.where("any").join(digests, "row", "left")
    none = {"base_sha256": F.sha2(F.lit(""), 256), "spans": F.lit("")}
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example"]
    fill = lambda n: none.get(n, F.lit(0).cast("long"))
    some = some.select("doc_id", *(F.coalesce(n, fill(n)).alias(n) for n in names))
    return some.unionAll(rows.where("not any").select("doc_id", *(fill(n).alias(n) for n in names)))


def scan_sql() -> str:
    """The query in DuckDB's SQL."""
    quoted = {k: p.replace("'", "''") for k, p in zip(KINDS, (ASSIGN, ACCESS, HEX, LOOSE), strict=True)}
    found = []
    for k, (_, pattern) in enumerate(quoted.items()):
        group = 2 if k == 0 else 0
        found.append(f"SELECT doc_id, source, {k} AS kind, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS whole, regexp_extract_all(t, '{pattern}', {group}) AS vals FROM docs WHERE regexp_matches(t, '{pattern}')")
    span = "[" + ", ".join(f"'{k}'" for k in KINDS) + "][kind + 1] || ':' || CAST(s AS VARCHAR) || ':' || CAST(e AS VARCHAR)"
    joined = f"string_agg({span}, ',' ORDER BY s, kind)"
    return f"""
WITH docs AS MATERIALIZED (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(found)}),
each AS (SELECT doc_id, source, kind, unnest(range(len(whole))) AS ord, unnest(whole) AS whole, unnest(vals) AS value, unnest(gaps[1:len(whole)]) AS gap FROM found),
ends AS (SELECT doc_id, source, kind, whole, value, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY ord ROWS UNBOUNDED PRECEDING) AS e0 FROM each),
placed AS (
  SELECT doc_id, source, kind, CAST(e0 AS BIGINT) - length(whole) AS s, CASE WHEN kind < 3 THEN CAST(e0 AS BIGINT) ELSE CAST(e0 AS BIGINT) - length(whole) + length(rtrim(whole, '.')) END AS e,
         CASE WHEN kind < 3 THEN value ELSE rtrim(whole, '.') END AS value FROM ends
), passed AS (
  SELECT * FROM placed WHERE CASE WHEN kind = 0 THEN length(value) >= 8 WHEN kind = 3 THEN length(value) >= {LOOSE_CHARS} AND regexp_matches(value, '[A-Za-z]') ELSE TRUE END
), spans AS (
  SELECT *, rtrim(value, '.=') AS v FROM passed p
  WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM passed b WHERE b.doc_id = p.doc_id AND b.kind < 3 AND b.s < p.e AND p.s < b.e)
), known AS (
  SELECT v, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS n_owners, sum(CASE WHEN kind < 3 THEN 1 ELSE 0 END) AS n_named FROM spans GROUP BY v
), rated AS (
  SELECT doc_id, kind, s, e, n_owners FROM spans JOIN known USING (v)
  WHERE kind < 3 OR (n_owners < {EXAMPLE_OWNERS} AND (n_named > 0 OR (length(value) >= {RANDOM_CHARS} AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]')
        AND len(list_distinct(string_split(value, ''))) >= {RANDOM_DISTINCT})))
), digests AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         coalesce({joined} FILTER (kind < 3), '') AS base, coalesce({joined}, '') AS spans,
         count(*) FILTER (n_owners < {EXAMPLE_OWNERS}) AS n_live, count(*) FILTER (n_owners >= {EXAMPLE_OWNERS}) AS n_example FROM rated GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs d LEFT JOIN digests g ON d.doc_id = g.doc_id
"""
