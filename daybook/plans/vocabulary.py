"""The phrases of the rules once more, every form written out, for the SQL twins alone: they share nothing with ``functions/rules.py``.

Fixed values, a rule a line. A space is any white space and ``0`` any number.
"""

from __future__ import annotations

import re

TITLE = """
live-music: concert, concerts, live music, open mic, open mics, karaoke, jam session, jam sessions, acoustic, singer, singers, songwriter, songwriters, gig, gigs, band, bands, dj, vinyl night
performing-arts: theater, theaters, theatre, theatres, comedy, improv, dance, dances, ballet, opera, musical, musicals, on stage, playhouse, burlesque, storytelling
film: film, films, movie, movies, cinema, screening, screenings, documentary, documentaries, zinema, matinee
visual-arts: gallery, galleries, exhibit, exhibits, exhibition, exhibitions, art walk, artist reception, opening reception, painting, paintings, sculpture, sculptures, art show, pottery, ceramics
class: workshop, workshops, lesson, lessons, clinic, clinics, course, courses, training, learn to, instruction, summer camp, summer camps, day camp, day camps, art camp, art camps, kid camp, kid camps, kids camp, kids camps, youth camp, youth camps, science camp, science camps, music camp, music camps, sport camp, sport camps, sports camp, sports camps, camps, class, classes
meeting: city council, commission, commissions, committee, committees, hearing, hearings, caucus, authority, board meeting, board meetings, board of, public meeting, town hall
market: farmermarket, farmermarkets, farmer market, farmer markets, farmersmarket, farmersmarkets, farmers market, farmers markets, makermarket, makermarkets, maker market, maker markets, makersmarket, makersmarkets, makers market, makers markets, flea market, flea markets, bazaar, craft fair, craft fairs, market, markets
festival: festival, festivals, fest, fair, fairs, homegrown, celebration, celebrations, winter village, daze, parade, parades
sports: soccer, volleyball, football, basketball, baseball, softball, hockey, tennis, golf, wrestling, swimming, lacrosse, rugby, track and field, track & field, cross country, ultimate frisbee, game, games, league, leagues, tournament, tournaments, invitational, invitationals, race, races, 0k, marathon, marathons, triathlon, triathlons, athletic, athletics, vs
family: storytime, storytimes, story time, story times, toddler, toddlers, preschool, pre-school, storyfolk, kid program, kid activity, kid hour, kids program, kids activity, kids hour, childrens program, childrens hour, children's program, children's hour
food-drink: tasting, tastings, brewery, breweries, brewpub, taproom, taprooms, wine, food truck, food trucks, potluck, potlucks, happy hour, dinner, dinners, brunch, coop, co-op, pancake breakfast, seafood boil
education: lecture, lectures, talk, talks, author, authors, book club, book clubs, reading, readings, seminar, seminars, planetarium, webinar, webinars, symposium, symposia, summit, summits, conference, conferences, in conversation
community: volunteer, volunteers, volunteering, cleanup, cleanups, clean-up, clean-ups, blood drive, blood drives, job fair, job fairs, career fair, career fairs, open house, fundraiser, fundraisers, food drive, food drives, town cleanup, work day
"""
VENUE = """
live-music: concert cafe, music hall, amphitheater, amphitheatre, bandshell, nightclub, listening room
performing-arts: theater, theatre, playhouse, opera house, auditorium
education: planetarium, library, observatory
visual-arts: gallery, art museum, art institute
sports: arena, stadium, fieldhouse, field house, ice rink, ballpark, speedway, golf course, curling club
food-drink: brewery, brewing, brewpub, taproom, winery, distillery, coop, co-op
"""
TEXT = """
all-ages: all ages, all-ages, family friendly, family-friendly, for the whole family
kids: storytime, story time, toddler, toddlers, infant, infants, babies, preschool, pre-school, prek, pre-k, kid, kids, children
teen: teen, teens, tween, tweens, young adult, young adults
seniors: senior, seniors, older adult, older adults
donation: donation, donations, pay what you can, freewill offering, free-will offering
free: free admission, free entry, free entrance, free show, free event, free concert, free and open, free to attend, free to the public, free of charge, free for all, admission is free, entry is free, entrance is free, parking is free, attendance is free, no fee, no charge, no cost, no admission fee, no admission charge, no admission cost
drop-in: drop-in, drop in, no registration, no signup, no sign-up, no sign up, registration not required
required: registration required, registration is required, preregistration required, pre-registration required, must register, rsvp required, signup required, sign-up required, sign up required, registration is necessary, space is limited
open: register, registration, rsvp, signup, sign-up, sign up, ticket required, ticket available, tickets required, tickets available, ticket are required, ticket are available, tickets are required, tickets are available
virtual: virtual, virtually, online, zoom, webinar, livestream, livestreamed, remote, teams meeting, z.umn.edu
outdoor: outdoor, outdoors, rain or shine, weather permitting, in the park, on the pier, on the beach, on the lawn, on the trail, on the water, trailhead, campground, bring blanket, bring a blanket, bring lawn chair, bring a lawn chair, field trip, hike, paddle
outdoor venue: park, beach, trail, garden, gardens, point
wheelchair: wheelchair, ada accessible, ada-accessible, fully accessible, accessible venue, accessible entrance, accessible seating, accessible parking, accessible event, mobility accessible, mobility-accessible
asl: asl, sign language, interpreted, interpretation, interpreter, cart, captioned
sensory-friendly: sensory friendly, sensory-friendly, sensory inclusive, sensory-inclusive, quiet hour, quiet room, quiet space, low sensory, low-sensory
alcohol: brewery, breweries, brewing, brewpub, taproom, distillery, distilleries, winery, wineries, nightclub, tavern, saloon, pub, cocktail, cocktails, beer, wine tasting, cash bar, happy hour
public: open to the public
restricted: students only, members only, staff only, invitation only
notice: final exam, final exams, last day, first day, no class, no classes, class begin, class end, class resume, classes begin, classes end, classes resume, faculty appointment, faculty appointments, registration opens, registration begins, registration closes, grade due, grades due, commencement rehearsal, term begins, term ends, break begins, holiday - no, university closed, semester begins, semester ends
rescheduled: rescheduled, re-scheduled, postponed, new date, date changed, canceled, cancelled
home: vs, versus
away: at
"""


def parsed(text: str) -> dict[str, list[str]]:
    return {name: [p.strip() for p in phrases.split(",")] for name, phrases in (line.split(": ", 1) for line in text.strip().splitlines())}


def pattern(phrases: list[str]) -> str:
    """An alternation of the phrases for a regular expression."""
    return "|".join(re.sub(r"[.+*?$^|()]", r"\\\g<0>", p).replace(" ", r"\s+").replace("0", r"\d+") for p in phrases)


TITLE_PHRASES, VENUE_PHRASES, TEXT_PHRASES = parsed(TITLE), parsed(VENUE), parsed(TEXT)
