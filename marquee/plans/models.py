"""The models: staging (M1), three bridges (M2-M4), the title mart (M5).

Plan design
-----------
The reference explodes each multi-value cell into a bridge table and then
re-aggregates the bridges per ``show_id`` and joins them back to build the
mart; analyses join bridges to the mart again.  All of those joins and
group-bys are keyed by ``show_id``.  When ``show_id`` is unique (the contract
checked by assertion T1) all of those of the build are 1:1, so it is a
narrow projection of the landed rows: each packed cell is split once into
trimmed tokens (blanks kept as '' so positions survive), and
posexplode / array_remove / size / array_join replace
explode+window+group+join, all inside whole-stage codegen.  The only shuffles
left are the analyses' own final group-bys (map-side combined).

Uniqueness is *checked*, not assumed: one aggregation over the key column
alone, run when a lazy ``Catalogue`` is first asked for a model (so asking may
run a job, and the plan is settled then).  When it fails, a title's counts
come from one ``groupBy(show_id)`` of bounded aggregates, which merge map-side
however many copies a key has, and are joined to the per-copy rows (a plain
join, many rows on its left: AQE splits a hot key).  Both ways give the same
schemas and the reference's relational results.

Analyses and assertions read the bridges and the mart.  In a built catalogue
(``with_models``) those are the written tables.  Bridge x mart analyses join
the bridge to the mart reduced to one row per title (``title_stats``), so
copies never multiply into copy x copy rows.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import (
    audience_band, blank_to_null, clean, normalise_genre,
    parse_month_day_year, present_tokens, to_int, token_parts, unit_measure,
)

STAGING_COLUMNS = (
    "show_id", "title_type", "title", "director_raw", "cast_raw", "country_raw",
    "genres_raw", "date_added", "release_year", "rating", "duration_minutes", "seasons",
    "duration_raw", "description", "year_added", "month_added",
    "years_release_to_platform", "audience_band",
)

MART_COLUMNS = (
    "show_id", "title", "title_type", "release_year", "date_added", "year_added",
    "month_added", "years_release_to_platform", "rating", "audience_band",
    "duration_minutes", "seasons", "primary_country", "country_count", "all_countries",
    "primary_genre", "genre_count", "all_genres", "cast_size", "director_count",
    "directors", "description", "missing_director", "missing_cast", "missing_country",
    "missing_date_added", "missing_rating", "completeness_score",
)

# Mart-side measures pre-aggregated per title for bridge x mart analyses.
MEASURES = {"ry": "release_year", "dm": "duration_minutes", "se": "seasons"}


def staging(raw: DataFrame) -> DataFrame:
    """M1: one typed, trimmed row per landed row with a key.  Narrow only."""
    typed = raw.filter(F.col("show_id").isNotNull()).select(
        clean("show_id").alias("show_id"),
        clean("type").alias("title_type"),
        clean("title").alias("title"),
        blank_to_null("director").alias("director_raw"),
        blank_to_null("cast").alias("cast_raw"),
        blank_to_null("country").alias("country_raw"),
        blank_to_null("listed_in").alias("genres_raw"),
        parse_month_day_year("date_added").alias("date_added"),
        to_int(clean("release_year")).alias("release_year"),
        blank_to_null("rating").alias("rating"),
        unit_measure("duration", "min").alias("duration_minutes"),
        unit_measure("duration", "season").alias("seasons"),
        blank_to_null("duration").alias("duration_raw"),
        blank_to_null("description").alias("description"),
        audience_band("rating").alias("audience_band"),
    )
    # The date is parsed once above; its parts are derived from the result.
    year_added = F.year("date_added").cast("bigint")
    return typed.select(
        *[c for c in STAGING_COLUMNS[:14]],
        year_added.alias("year_added"),
        F.month("date_added").cast("bigint").alias("month_added"),
        (year_added - F.col("release_year")).alias("years_release_to_platform"),
        "audience_band",
    )


def has_unique_keys(stg: DataFrame) -> bool:
    """True when no ``show_id`` occurs twice.  Reads only the key column;
    map-side partial counts keep the shuffle to one row per key and task."""
    dup = stg.groupBy("show_id").count().filter(F.col("count") > 1)
    return len(dup.select("show_id").take(1)) == 0


def _token_columns(stg: DataFrame, strict: bool = True) -> DataFrame:
    """Per landed row: the split tokens of its four packed cells
    (array<string>, trimmed, blanks kept as '')."""
    return stg.select(
        "*",
        token_parts("country_raw", strict=strict).alias("c_parts"),
        token_parts("genres_raw", strict=strict).alias("g_parts"),
        token_parts("cast_raw", strict=strict).alias("a_parts"),
        token_parts("director_raw", strict=strict).alias("d_parts"),
    )


def _nonempty(arr: Column, value: Column) -> Column:
    return F.when(F.size(arr) > 0, value)


def _first(parts: Column, strict: bool) -> Column:
    """The token at position 1 when it is a token (NULL otherwise)."""
    first = F.try_element_at(parts, F.lit(1))
    return F.nullif(first, F.lit("")) if strict else first


def _title_level(strict: bool = True) -> list[Column]:
    """Per-title rollups from the row's own tokens.  A title with no tokens
    of a kind has no bridge rows, hence NULL after the reference's left
    join.  Only ``all_genres`` needs a lambda (element-wise relabelling)."""
    c = present_tokens(F.col("c_parts"), strict)
    g = present_tokens(F.col("g_parts"), strict)
    a = present_tokens(F.col("a_parts"), strict)
    d = present_tokens(F.col("d_parts"), strict)
    people = F.size(a) + F.size(d)
    return [
        _first(F.col("c_parts"), strict).alias("primary_country"),
        _nonempty(c, F.size(c).cast("bigint")).alias("country_count"),
        _nonempty(c, F.array_join(c, ", ")).alias("all_countries"),
        normalise_genre(_first(F.col("g_parts"), strict)).alias("primary_genre"),
        _nonempty(g, F.size(g).cast("bigint")).alias("genre_count"),
        _nonempty(g, F.array_join(F.transform(g, normalise_genre), ", ")).alias("all_genres"),
        F.when(people > 0, F.size(a).cast("bigint")).alias("cast_size"),
        F.when(people > 0, F.size(d).cast("bigint")).alias("director_count"),
        _nonempty(d, F.array_join(d, ", ")).alias("directors"),
    ]


def _tokens_of(df: DataFrame, kind: str, keep: list, strict: bool = True) -> DataFrame:
    """Explode one token kind to rows with ``t = struct(pos, name, ...)``
    (``norm`` for genres, ``role`` for people), blank tokens dropped.
    Generate + filter only, so the stage stays in whole-stage codegen."""
    if kind == "people":
        roles = df.select(*keep, F.inline(F.array(
            F.struct(F.lit("actor").alias("role"), F.col("a_parts").alias("parts")),
            F.struct(F.lit("director").alias("role"), F.col("d_parts").alias("parts")))))
        x = roles.select(*keep, "role", F.posexplode("parts").alias("i", "name"))
        extra = [F.col("role")]
    else:
        arr = {"countries": "c_parts", "genres": "g_parts"}[kind]
        x = df.select(*keep, F.posexplode(arr).alias("i", "name"))
        extra = [normalise_genre("name").alias("norm")] if kind == "genres" else []
    if strict:
        x = x.filter(F.col("name") != "")
    t = F.struct((F.col("i") + 1).cast("bigint").alias("pos"), F.col("name").alias("name"), *extra)
    return x.select(*keep, t.alias("t"))


def _measure_stats_agg() -> list[Column]:
    out = [F.count(F.lit(1)).alias("n_rows"),
           F.count_if(F.col("title_type") == "Movie").alias("n_movies"),
           F.count_if(F.col("title_type") == "TV Show").alias("n_tv")]
    for short, col in MEASURES.items():
        v = F.col(col)
        out += [F.sum(v.cast("bigint")).alias(f"{short}_sum"),
                F.count(v).alias(f"{short}_cnt"),
                F.min(v).alias(f"{short}_min"), F.max(v).alias(f"{short}_max")]
    return out


def _title_stats_agg(strict: bool = True) -> list[Column]:
    """Bounded per-title aggregates over the copies of a repeated key: all
    of them merge map-side, so a key with very many copies collapses to one
    partial row per task before the shuffle."""
    size = lambda c: F.size(present_tokens(F.col(c), strict))
    return [
        F.max(_first(F.col("c_parts"), strict)).alias("primary_country"),
        F.max(normalise_genre(_first(F.col("g_parts"), strict))).alias("primary_genre"),
        F.sum(size("c_parts")).alias("_nc"), F.sum(size("g_parts")).alias("_ng"),
        F.sum(size("a_parts")).alias("_na"), F.sum(size("d_parts")).alias("_nd"),
    ]


def _title_counts() -> list[Column]:
    nc, ng, na, nd = (F.col(c).cast("bigint") for c in ("_nc", "_ng", "_na", "_nd"))
    return [F.when(nc > 0, nc).alias("country_count"), F.when(ng > 0, ng).alias("genre_count"),
            F.when(na + nd > 0, na).alias("cast_size"),
            F.when(na + nd > 0, nd).alias("director_count")]


def _merged_tokens(copies: Column, strict: bool, shown=None) -> Column:
    """The tokens of all copies of a title in one string, by raw position and text (NULL without any)."""
    placed = F.flatten(F.transform(copies, lambda parts: F.transform(
        parts, lambda name, i: F.struct((i + 1).alias("pos"), name.alias("v")))))
    if strict:
        placed = F.filter(placed, lambda t: t["v"] != "")
    if shown is not None:
        placed = F.transform(placed, lambda t: F.struct(t["pos"], shown(t["v"]).alias("v")))
    return _nonempty(placed, F.array_join(F.array_sort(placed)["v"], ", "))


PART_COLUMNS = ["c_parts", "g_parts", "a_parts", "d_parts"]

class Catalogue:
    """Builds and holds the models for one landed catalogue.

    ``unique_keys`` may be passed when known (e.g. from a previous T1 run);
    otherwise it is checked once, lazily.  ``models`` replaces models by
    other frames under their table names (written tables, or deliberately broken
    ones); ``strict_tokens=False`` and ``mart_drop`` build deliberately
    broken models for the assertion tests.
    """

    def __init__(self, raw: DataFrame, unique_keys: bool | None = None,
                 strict_tokens: bool = True, mart_drop: Column | None = None,
                 models: dict[str, DataFrame] | None = None):
        self.raw = raw
        self.strict_tokens = strict_tokens
        self.mart_drop = mart_drop
        self.models = dict(models or {})
        self._unique = unique_keys
        # Lazy values that cost a Spark job are computed once even when
        # several driver threads (concurrent jobs) ask at the same time.
        self._lock = threading.RLock()

    def with_models(self, models: dict[str, DataFrame]) -> "Catalogue":
        """The same catalogue reading ``models`` (by table name) instead of deriving them."""
        return Catalogue(self.raw, self._unique, self.strict_tokens, self.mart_drop,
                         {**self.models, **models})

    # -- M1 ---------------------------------------------------------------
    @property
    def staging(self) -> DataFrame:
        if "stg_titles" in self.models:
            return self.models["stg_titles"]
        return staging(self.raw)

    @property
    def unique_keys(self) -> bool:
        with self._lock:
            if self._unique is None:
                self._unique = has_unique_keys(self.staging)
        return self._unique

    def _tokens(self) -> DataFrame:
        return _token_columns(self.staging, self.strict_tokens)

    def _title_rollups(self) -> DataFrame:
        """Per distinct show_id: counts and primary values over all copies of
        the key (bounded aggregates only)."""
        stats = self._tokens().groupBy("show_id").agg(*_title_stats_agg(self.strict_tokens))
        return stats.select("show_id", "primary_country", "primary_genre", *_title_counts())

    # -- M2-M4 ------------------------------------------------------------
    def _explode(self, kind: str, *extra: str) -> DataFrame:
        keep = ["show_id", "title_type", *extra]
        if self.unique_keys:
            rows = self._tokens().select("show_id", "title_type", *PART_COLUMNS,
                                         *_title_level(self.strict_tokens))
        else:
            rows = self._tokens().select("show_id", "title_type", *PART_COLUMNS)
            if extra:
                # One row per landed copy on the left, one per title on the right.
                rows = rows.join(self._title_rollups().select("show_id", *extra), "show_id")
        return _tokens_of(rows, kind, keep, self.strict_tokens)

    @property
    def countries(self) -> DataFrame:
        """M2: one row per (title, country token), position from the raw list."""
        if "int_title_countries" in self.models:
            return self.models["int_title_countries"]
        return self._explode("countries", "country_count").select(
            "show_id", "title_type",
            F.col("t.name").alias("country"),
            F.col("t.pos").alias("country_position"),
            (F.col("t.pos") == 1).alias("is_primary_country"),
            "country_count")

    @property
    def genres(self) -> DataFrame:
        """M3: one row per (title, genre label) with the normalised genre."""
        if "int_title_genres" in self.models:
            return self.models["int_title_genres"]
        return self._explode("genres", "genre_count").select(
            "show_id", "title_type",
            F.col("t.name").alias("genre"),
            F.col("t.pos").alias("genre_position"),
            "genre_count",
            F.col("t.norm").alias("genre_normalised"))

    @property
    def people(self) -> DataFrame:
        """M4: actors and directors in one bridge with a role discriminator."""
        if "int_title_people" in self.models:
            return self.models["int_title_people"]
        return self._explode("people").select(
            "show_id", "title_type",
            F.col("t.name").alias("person_name"),
            F.col("t.role").alias("role"),
            F.col("t.pos").alias("billing_position"),
            ((F.col("t.role") == "actor") & (F.col("t.pos") <= 3)).alias("is_top_billed"))

    # -- M5 ---------------------------------------------------------------
    @property
    def mart(self) -> DataFrame:
        """M5: one row per staging row with rollups, flags and score."""
        if "dim_title" in self.models:
            return self.models["dim_title"]
        if self.unique_keys:
            # 1:1 with staging: a row's rollups come from its own tokens.
            wide = self._tokens().select(*STAGING_COLUMNS, *_title_level(self.strict_tokens))
        else:
            # The string rollups concatenate the tokens of every copy, as
            # the reference defines them; their size grows with the copies.
            # Counts and primary values come from bounded aggregates.
            # One group-by makes them all, so the tokens are shuffled once.
            strict = self.strict_tokens
            lists = {"all_countries": "c_parts", "all_genres": "g_parts", "directors": "d_parts"}
            found = self._tokens().groupBy("show_id").agg(
                *_title_stats_agg(strict), *[F.collect_list(parts).alias(name) for name, parts in lists.items()])
            rollups = found.select(
                "show_id", "primary_country", "primary_genre", *_title_counts(),
                *[_merged_tokens(F.col(name), strict, normalise_genre if name == "all_genres" else None).alias(name)
                  for name in lists])
            wide = self.staging.join(rollups, "show_id", "left")
        flags = {
            "missing_director": F.col("director_raw").isNull(),
            "missing_cast": F.col("cast_raw").isNull(),
            "missing_country": F.col("country_raw").isNull(),
            "missing_date_added": F.col("date_added").isNull(),
            "missing_rating": F.col("rating").isNull(),
        }
        score = sum((~f).cast("int") for f in flags.values())
        mart = wide.select(
            *[c for c in MART_COLUMNS[:22]],
            *[f.alias(n) for n, f in flags.items()],
            score.cast("int").alias("completeness_score"),
        )
        if self.mart_drop is not None:
            mart = mart.filter(~self.mart_drop)
        return mart

    # -- bridge x mart ----------------------------------------------------
    def title_stats(self) -> DataFrame:
        """The mart reduced to one row per title: its number of rows and the
        sums, counts, least and greatest values of their measures."""
        return self.mart.groupBy("show_id").agg(*_measure_stats_agg(),
                                                F.max("primary_country").alias("primary_country"))

    def bridge_facts(self, bridge: DataFrame) -> DataFrame:
        """Bridge rows with their title's mart measures.  A bridge row stands
        for its join with the title's ``n_rows`` mart rows: aggregating
        ``n_rows`` and the sums equals aggregating bridge JOIN mart."""
        return bridge.join(self.title_stats(), "show_id")

    def pair_facts(self) -> DataFrame:
        """Per title: its distinct countries with multiplicity, paired (a < b)
        and weighted, next to the title's mart measures (for Q10)."""
        from marquee.operators.pairs import weighted_pairs
        return self.bridge_facts(weighted_pairs(self.countries, "show_id", "country"))
