"""Every operator as a query over the standard tables, with its SQL counterpart."""
from oppflow.catalog import (  # noqa: F401
    digests, intake, portal_pages, sections, streams, tagging, terms,
)
from oppflow.catalog.base import ORACLES, QUERIES  # noqa: F401
