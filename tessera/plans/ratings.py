"""Ratings analytics: mean and count per movie, genre, gender, age bucket, occupation, year.

Inputs are DataFrames with caller-named columns (defaults: ratings(user, movie, rating, ts),
movies(movie, title, genres), users(user, gender, age, occupation), occupations(id, name)).
Where the result needs only the dimension's key (movie, genre, occupation), ratings are reduced to a
sum and a count per key before the join; where it needs two keys at once (movie with gender or age),
each rating joins its user or movie first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.logic import bucketize
from tessera.functions.time import epoch_year
from tessera.operators.aggregate import (explode_labels, mean_count, merged_mean, pivot_mean,
                                         sum_count)
from tessera.operators.joins import join_full_outer, lookup
from tessera.operators.rank import argmax
from tessera.sources.tables import union_sources

# The two age-bucket conventions (edges and labels) of the reference jobs.
AGE_EDGES = (18, 35, 50)
AGE_LABELS_LEFT = ("0-18", "18-35", "35-50", "50+")        # x<18, x<35, x<50, else
AGE_LABELS_RIGHT = ("Under 18", "18-35", "36-50", "50+")   # x<18, x<=35, x<=50, else
UNKNOWN = "Unknown"


def movie_mean_count(rating_parts: Sequence[DataFrame], movies: DataFrame, *, movie: str = "movie",
                     title: str = "title", rating: str = "rating",
                     mean_name: str = "mean_rating", count_name: str = "n_ratings") -> DataFrame:
    """Mean and count per movie over several rating inputs, keeping every key of both sides.

    A movie without ratings gets count 0 and a NULL mean; a rating for an unknown movie gets the
    empty title.
    """
    stats = mean_count(union_sources(*rating_parts), movie, rating, mean_name, count_name)
    return join_full_outer(movies.select(movie, title), stats, movie,
                           defaults={title: "", count_name: 0})


def best_rated_movie(stats: DataFrame, *, movie: str = "movie", mean_name: str = "mean_rating",
                     count_name: str = "n_ratings", min_support: int = 5) -> DataFrame:
    """Highest mean among movies with at least ``min_support`` ratings (tie: lowest key)."""
    return argmax(stats, movie, mean_name, count_name, min_support)


def genre_mean(ratings: DataFrame, movies: DataFrame, *, movie: str = "movie",
               genres: str = "genres", rating: str = "rating", sep: str = "|",
               label: str = "genre") -> DataFrame:
    """Mean and count per genre; a rating counts once for each genre of its movie."""
    per_movie = sum_count(ratings, movie, rating).join(movies.select(movie, genres), movie)
    return merged_mean(explode_labels(per_movie, genres, sep, label), label, "mean_rating",
                       "n_ratings").orderBy(label)


def with_user_attrs(ratings: DataFrame, users: DataFrame, attrs: Sequence[str], *,
                    user: str = "user") -> DataFrame:
    """Ratings carrying user attributes (second hop of user -> rating -> movie)."""
    return ratings.join(users.select(user, *attrs), user, "inner")


def movie_gender_wide(ratings: DataFrame, users: DataFrame, movies: DataFrame, *,
                      values: Mapping[str, str], movie: str = "movie", title: str = "title",
                      user: str = "user", gender: str = "gender", rating: str = "rating",
                      default: float = 0.0) -> DataFrame:
    """One row per movie with a mean column per listed gender value; missing -> ``default``.

    Values not listed are ignored.  Movies without ratings appear with the default everywhere.
    """
    rated = with_user_attrs(ratings.select(user, movie, rating), users, [gender], user=user)
    wide = pivot_mean(rated, movie, gender, values, rating, default=None)
    out = movies.select(movie, title).join(wide, movie, "full")
    for c in values.values():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(default)))
    return out.withColumn(title, F.coalesce(F.col(title), F.lit("")))


def movie_gender_long(ratings: DataFrame, users: DataFrame, *, movie: str = "movie",
                      user: str = "user", gender: str = "gender", rating: str = "rating") -> DataFrame:
    """Mean and count per (movie, gender)."""
    rated = with_user_attrs(ratings.select(user, movie, rating), users, [gender], user=user)
    return mean_count(rated, [movie, gender], rating, "mean_rating", "n_ratings")


def age_bucket(age: str, closed: str, labels: Sequence[str] | None = None,
               edges: Sequence[float] = AGE_EDGES):
    labels = labels or (AGE_LABELS_LEFT if closed == "left" else AGE_LABELS_RIGHT)
    return bucketize(age, edges, labels, closed)


def movie_age_wide(rated: DataFrame, *, movie: str = "movie", age: str = "age",
                   rating: str = "rating", closed: str = "left",
                   labels: Sequence[str] | None = None, names: Sequence[str] | None = None,
                   default: float | None = None) -> DataFrame:
    """One row per movie, one mean column per age bucket; an empty bucket stays NULL (``default``
    None) so a formatter can print "NA"."""
    labels = list(labels or (AGE_LABELS_LEFT if closed == "left" else AGE_LABELS_RIGHT))
    names = list(names or [f"mean_{i}" for i in range(len(labels))])
    bucketed = rated.withColumn("__bucket", age_bucket(age, closed, labels))
    return pivot_mean(bucketed, movie, "__bucket", dict(zip(labels, names)), rating, default)


def movie_age_long(rated: DataFrame, *, movie: str = "movie", age: str = "age",
                   rating: str = "rating", closed: str = "right",
                   labels: Sequence[str] | None = None, bucket: str = "age_group") -> DataFrame:
    """Mean and count per (movie, age bucket)."""
    bucketed = rated.withColumn(bucket, age_bucket(age, closed, labels))
    return mean_count(bucketed, [movie, bucket], rating, "mean_rating", "n_ratings")


def occupation_mean(ratings: DataFrame, users: DataFrame, occupations: DataFrame, *,
                    user: str = "user", occupation: str = "occupation", occ_id: str = "id",
                    occ_name: str = "name", rating: str = "rating",
                    default: str = UNKNOWN) -> DataFrame:
    """Mean and count per occupation name; ids missing from the dictionary -> ``default``."""
    per_user = sum_count(ratings, user, rating).join(users.select(user, occupation), user)
    per_id = per_user.groupBy(occupation).agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
    named = lookup(per_id, occupations, (occupation, occ_id), occ_name, default,
                   out="occupation_name")
    return merged_mean(named, "occupation_name", "mean_rating", "n_ratings") \
        .orderBy("occupation_name")


def year_mean(ratings: DataFrame, *, ts: str = "ts", rating: str = "rating") -> DataFrame:
    """Mean and count per calendar year of the epoch-seconds timestamp (session tz = UTC)."""
    return mean_count(ratings.withColumn("year", epoch_year(ts)), "year", rating,
                      "mean_rating", "n_ratings").orderBy("year")
