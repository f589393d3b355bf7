"""The operators run over the given star-schema tables, each beside its SQL oracle."""
