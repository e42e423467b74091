"""The movie-ratings schema: column types and the rules of each table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """Column types as a DDL text, and the rules rows must obey.

    ``foreign_keys`` maps a column to the (table, column) it refers to;
    ``checks`` are SQL conditions.
    """

    columns: str
    required: tuple[str, ...]
    keys: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()
    checks: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


RATINGS_SCHEMA: dict[str, TableSpec] = {
    "users": TableSpec("userid int, name string", ("userid", "name"), (("userid",),)),
    "movies": TableSpec("movieid int, title string", ("movieid", "title"), (("movieid",),)),
    "taginfo": TableSpec("tagid int, content string", ("tagid", "content"), (("tagid",),)),
    "genres": TableSpec("genreid int, name string", ("genreid", "name"), (("genreid",),)),
    "ratings": TableSpec(
        "userid int, movieid int, rating decimal(3,1), timestamp bigint",
        ("userid", "movieid", "rating", "timestamp"),
        (("userid", "movieid", "rating"),),
        (("userid", "users", "userid"), ("movieid", "movies", "movieid")),
        ("rating >= 0 AND rating <= 5",),
    ),
    "tags": TableSpec(
        "userid int, movieid int, tagid int, timestamp bigint",
        ("userid", "movieid", "tagid"),
        (),
        (
            ("userid", "users", "userid"),
            ("movieid", "movies", "movieid"),
            ("tagid", "taginfo", "tagid"),
        ),
    ),
    "hasagenre": TableSpec(
        "movieid int, genreid int",
        ("movieid", "genreid"),
        (("movieid", "genreid"),),
        (("movieid", "movies", "movieid"), ("genreid", "genres", "genreid")),
    ),
}
