"""Named queries over the star-schema test tables, each with its SQL counterpart."""
