"""Plain-SQL statements of what each registered query must return."""
