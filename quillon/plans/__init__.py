"""Views of the test tables as the engine's entities, and the registered queries with their SQL."""
