"""Imports every module that registers queries."""

from gleaner.plans import carried, checks, citing, documents, filling, guides, lore, merged, merging, metagame, pagejson, pages, printings, records, relations, resolving, schedule, today, whole, winning  # noqa: F401
