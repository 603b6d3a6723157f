"""The test tables seen as transactions, and the queries run over them."""
