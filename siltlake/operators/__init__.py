"""DataFrame -> DataFrame operators: normalisation, quality, relational, layout, change data, synthesis."""
