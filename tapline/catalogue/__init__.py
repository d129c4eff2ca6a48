"""Named queries over the given tables, one or more per operator, and the SQL that gives the same rows."""

from tapline.catalogue import outputs, shapes, sources, types

QUERIES = {**shapes.QUERIES, **types.QUERIES, **sources.QUERIES, **outputs.QUERIES}
SQL = {**shapes.SQL, **types.SQL, **sources.SQL, **outputs.SQL}
