"""The library's operators as queries over the supplied tables, with SQL oracles."""
