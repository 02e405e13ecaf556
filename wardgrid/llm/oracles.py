"""SQL that DuckDB runs on the same tables, for the operators that SQL can express."""

from __future__ import annotations

from . import centroids, mixing, spelling

# ---------------------------------------------------------------- spelling
_LOWER = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: crc32 of column ``bytes`` (hexadecimal), bit by bit.
_CRC32 = """xor(list_reduce(
    list_transform(range(length(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::bigint),
    lambda c, b: list_reduce(range(8), lambda r, s: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(c, b)),
    4294967295), 4294967295)"""

SPELLING_SQL = f"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::varchar, '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), lowered AS (
    SELECT id, {_LOWER} AS run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
    SELECT run, n, {_CRC32} AS h FROM (SELECT *, hex(encode(id || ':' || run)) AS bytes FROM lowered)
), slipped AS (
    SELECT CASE WHEN h % {spelling.SLIP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, sum(n)::bigint AS n FROM slipped GROUP BY word HAVING length(word) >= {spelling.MIN_LENGTH} AND sum(n) >= {spelling.MIN_COUNT}
), shorter AS (
    SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), links AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.short = b.word
    UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.short = b.word
), best AS (
    SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM links
), forms AS (
    SELECT words.word, words.n, coalesce(n_near, 0)::bigint AS n_near, CASE WHEN near_n >= {spelling.FACTOR} * words.n THEN near END AS form,
        CASE WHEN near_n >= {spelling.FACTOR} * words.n THEN near_n END AS form_n
    FROM words LEFT JOIN best ON best.word = words.word AND place = 1
), walked AS (
    SELECT word, word AS root, 0 AS step FROM words
    UNION ALL SELECT walked.word, forms.form, step + 1 FROM walked JOIN forms ON forms.word = walked.root WHERE forms.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(root, step) AS root FROM walked GROUP BY word) USING (word)
"""

# ---------------------------------------------------------------- mixing
_WEIGHT = f"list_value({', '.join(f'{float(w)}::double' for w in mixing.WEIGHTS)})[(place - 1) % {len(mixing.WEIGHTS)} + 1]"
MIXING_SQL = rf"""
WITH sized AS (
    SELECT doc_id, coalesce(source, '') AS source, source IS NULL AS no_source,
        coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size,
        sha256('{mixing.SEED}:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) AS draw
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (ORDER BY no_source, source) AS place FROM (SELECT source, no_source, sum(size)::bigint AS source_size FROM sized GROUP BY ALL)
), weighed AS (
    SELECT *, {_WEIGHT} AS weight, source_size * {float(mixing.EPOCHS)}::double AS most, {mixing.SHARE}::double * sum(source_size) OVER () AS wanted FROM placed
), clamped AS (
    SELECT *, coalesce(sum(most) OVER before, 0) AS full_before, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free
    FROM weighed WINDOW before AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
    SELECT coalesce(arg_min((wanted - full_before) / free, most / weight) FILTER ((wanted - full_before) / free <= most / weight), 0) AS level FROM clamped
), targets AS (
    SELECT source, no_source, source_size, CASE WHEN weight * level > most THEN most ELSE weight * level END AS target FROM clamped, water
), plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::bigint AS whole FROM targets
), drawn AS (
    SELECT *, floor(target - whole * source_size)::bigint AS more FROM plan
), equal AS (
    SELECT source, no_source, draw, sum(size) AS words, count(*) AS mates FROM sized WHERE size > 0 GROUP BY ALL
), ordered AS (
    SELECT *, coalesce(sum(words) OVER (PARTITION BY no_source, source ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM equal
)
SELECT doc_id, size, source_size, target,
    (whole * size + CASE WHEN size = 0 THEN 0 ELSE least(size, greatest(0, floor((more - before) / mates))) END)::bigint AS taken
FROM sized JOIN drawn USING (source, no_source) LEFT JOIN ordered USING (source, no_source, draw)
"""

# ---------------------------------------------------------------- centroids
_K, _DIM, _SCALE = centroids.CENTROIDS, centroids.DIMENSIONS, centroids.SCALE


def _assigned(at: int) -> str:
    """Nearest centroid of every vector in round ``at``."""
    apart = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    return f"""near{at} AS (
    SELECT id, vec_id, v, arg_min(cluster, (apart, cluster)) AS cluster, min(apart) AS distance
    FROM (SELECT id, vec_id, v, cluster, {apart} AS apart FROM kept, cent{at}) GROUP BY id, vec_id, v
)"""


def _moved(at: int) -> str:
    floored = "(total - ((total % n) + n) % n) // n"
    return f"""sums{at} AS (
    SELECT cluster, i, sum(x) AS total, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range({_DIM})) AS i FROM near{at}) GROUP BY cluster, i
), cent{at + 1} AS (
    SELECT cluster, coalesce(m, c) AS c FROM cent{at} LEFT JOIN (SELECT cluster, list(({floored})::bigint ORDER BY i) AS m FROM sums{at} GROUP BY cluster) USING (cluster)
)"""


_ROUNDS = ",\n".join(f"{_assigned(r)}, {_moved(r)}" for r in range(centroids.ROUNDS))
CENTROID_SQL = f"""
WITH kept AS (
    SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(x::double * {_SCALE})::bigint) AS v
    FROM embeddings WHERE length(embedding) = {_DIM} AND len(list_filter(embedding, lambda x: isfinite(x))) = {_DIM}
), cent0 AS (
    SELECT (row_number() OVER (ORDER BY draw, v) - 1)::int AS cluster, v AS c
    FROM (SELECT v, sha256('{centroids.SEED}:' || coalesce(vec_id::varchar, '')) AS draw FROM kept) ORDER BY draw, v LIMIT {_K}
), {_ROUNDS}, {_assigned(centroids.ROUNDS)}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::bigint AS cluster_inertia, (sum(distance) OVER ())::bigint AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{centroids.ROUNDS} JOIN cent{centroids.ROUNDS} USING (cluster)
"""
