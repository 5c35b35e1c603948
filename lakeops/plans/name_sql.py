"""SQL twin of the weighted name ratio (``functions/similarity.py``), for names of up to 60 characters.

The longest common subsequence by bits: a state of one bit per character of the second text, folded over the first one's characters.  Only
pairs are computed that can reach the threshold by their Levenshtein distance, which is never over the distance in insertions and deletions.
"""

from __future__ import annotations


def lcs_sql(a: str, b: str) -> str:
    full = f"((1::BIGINT << length({b})) - 1)"
    mask = f"list_sum([0] || list_transform(range(length({b})), lambda i: CASE WHEN substr({b}, i + 1, 1) = c THEN 1::BIGINT << i ELSE 0 END))::BIGINT"
    masks = f"list_transform(string_split({a}, ''), lambda c: {mask})"
    state = f"list_reduce([{full}] || {masks}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE length({b}) - bit_count({state}) END"


def ratio_sql(a: str, b: str) -> str:
    return f"200.0::DOUBLE * ({lcs_sql(a, b)})::DOUBLE / greatest(length({a}) + length({b}), 1)::DOUBLE"


def weighted_pairs(left: str, right: str, threshold: float) -> str:
    """CTEs that end in ``sc`` (lname, rname, score) with the pairs of two tables of distinct names at or over a threshold over 85.5."""
    spare = 1 - threshold / 100 + 1e-9
    by_words = 1 - min(1.0, threshold / 95) + 1e-9

    def worded(table: str) -> str:
        return (f"SELECT name, array_to_string(w, ' ') AS sorted, list_sort(list_distinct(w)) AS once FROM "
                f"(SELECT name, list_sort(list_filter(string_split(name, ' '), lambda x: x <> '')) AS w FROM {table}) q WHERE name <> ''")

    near = "greatest(length(l.name), length(r.name)) < 1.5 * least(length(l.name), length(r.name))"
    return f"""
np0 AS (SELECT l.name AS a, r.name AS b, l.sorted AS sa, r.sorted AS sb, {near} AS near,
          array_to_string(list_filter(l.once, lambda x: list_contains(r.once, x)), ' ') AS shared,
          array_to_string(list_filter(l.once, lambda x: NOT list_contains(r.once, x)), ' ') AS ra,
          array_to_string(list_filter(r.once, lambda x: NOT list_contains(l.once, x)), ' ') AS rb
        FROM ({worded(left)}) l, ({worded(right)}) r),
np1 AS (SELECT *, length(shared) AS n, length(shared) + (CASE WHEN shared <> '' THEN 1 ELSE 0 END) AS n1 FROM np0),
np2 AS (SELECT *, CASE WHEN levenshtein(a, b) <= {spare} * (length(a) + length(b)) THEN {ratio_sql('a', 'b')} ELSE 0.0 END AS plain,
          CASE WHEN shared <> '' AND (ra = '' OR rb = '') THEN 100.0::DOUBLE
               WHEN shared <> '' THEN greatest(200.0::DOUBLE * n / (n + n1 + length(ra)), 200.0::DOUBLE * n / (n + n1 + length(rb))) ELSE 0.0 END AS by_shared
        FROM np1),
np3 AS (SELECT *,
          CASE WHEN near AND levenshtein(sa, sb) <= {by_words} * (length(sa) + length(sb)) AND 95.0 * (1 - levenshtein(sa, sb)::DOUBLE / (length(sa) + length(sb))) > plain
               THEN {ratio_sql('sa', 'sb')} ELSE 0.0 END AS by_sort,
          CASE WHEN near AND levenshtein(ra, rb) <= {by_words} * (2 * n1 + length(ra) + length(rb))
                    AND 95.0 * (1 - levenshtein(ra, rb)::DOUBLE / (2 * n1 + length(ra) + length(rb))) > plain
               THEN 100.0::DOUBLE * (1.0::DOUBLE - (length(ra) + length(rb) - 2 * ({lcs_sql('ra', 'rb')}))::DOUBLE / greatest(2 * n1 + length(ra) + length(rb), 1)::DOUBLE)
               ELSE 0.0 END AS by_rest FROM np2),
sc AS (SELECT lname, rname, score FROM (
         SELECT a AS lname, b AS rname,
           -- names of up to 22 characters lie in a longer one as they are, or score below 88 there
           CASE WHEN near THEN greatest(plain, 0.95::DOUBLE * greatest(by_sort, by_shared, by_rest))
                ELSE greatest(plain, CASE WHEN contains(a, b) OR contains(b, a) THEN 100.0::DOUBLE *
                     (CASE WHEN greatest(length(a), length(b)) <= 8 * least(length(a), length(b)) THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END) ELSE 0.0 END) END AS score
         FROM np3) q WHERE score >= {threshold} - 1e-9)"""
