"""Named queries over the driver's tables, with the SQL that gives the same rows."""

from . import records, reviews, text, whole_run, xml

QUERIES = {**records.QUERIES, **text.QUERIES, **reviews.QUERIES, **xml.QUERIES, **whole_run.QUERIES}
ORACLES = {**records.ORACLES, **text.ORACLES, **reviews.ORACLES, **xml.ORACLES, **whole_run.ORACLES}
