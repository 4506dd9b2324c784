"""Named queries over the test tables, each with an SQL statement where SQL can express it."""
