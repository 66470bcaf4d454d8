"""Frame operators: cleaning, silver, classification, star, growth, quality, audit."""
