"""DataFrame -> DataFrame operators the models are put together from."""
