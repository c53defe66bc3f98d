"""Plans built on the operators: star schema, measure library, time intelligence, feeds."""
