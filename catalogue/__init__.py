"""Checked queries over the test tables: adapter views, query registry, SQL for comparison."""
