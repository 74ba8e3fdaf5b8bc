"""DataFrame operators: quality, statistics, features, model, attach, sinks."""
