from stockledger.plans.feeds import Feeds, GivenFeeds
from stockledger.plans.ledger import Ledger

__all__ = ["Feeds", "GivenFeeds", "Ledger"]
