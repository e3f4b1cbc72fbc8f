"""Every operator applied to the test tables, with SQL that says the same."""
