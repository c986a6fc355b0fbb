"""Plans: the star schema layers and the trend reports over it."""
