"""How the driver's tables stand for projects, places and documents."""
